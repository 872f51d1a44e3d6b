"""End-to-end jobs (profiling report, training, streaming scoring) and the query catalogue."""
