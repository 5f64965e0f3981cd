"""Topics, tables, change envelopes and sinks."""
