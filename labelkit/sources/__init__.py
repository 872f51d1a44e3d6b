"""Table sources and sinks: delimited files, JSON messages, metadata, derived tables."""
