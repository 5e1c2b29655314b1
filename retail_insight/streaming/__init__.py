"""Structured Streaming: sources, the blacklist pipeline, running totals."""
