"""Registered queries: the operators over the provided tables, with their check SQL."""
