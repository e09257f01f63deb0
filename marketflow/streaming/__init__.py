"""Structured Streaming jobs built from the operators, sources and sinks."""
