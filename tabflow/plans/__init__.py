"""Jobs: a source, operators and a sink."""
