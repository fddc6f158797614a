"""Jobs that combine readers, operators and sinks."""
