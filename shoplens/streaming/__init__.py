"""Structured Streaming forms of the jobs, sources and sinks."""
