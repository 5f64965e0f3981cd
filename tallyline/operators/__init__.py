"""DataFrame operators: windows, orders, clicks, paths, reports, merchandising, web."""
