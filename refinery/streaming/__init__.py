"""Structured Streaming: bounded file ingest and windowed Gold metrics."""
