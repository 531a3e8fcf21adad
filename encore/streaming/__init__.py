"""Structured Streaming: sources, per-batch processing and windowed aggregates."""
