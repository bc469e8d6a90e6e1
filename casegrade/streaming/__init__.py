"""Incremental (Structured Streaming) ingest of landed files into bronze."""
