"""Sinks: parquet tables and text lines written to new, versioned directories."""
