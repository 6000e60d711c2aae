"""Incremental ingest of landing folders with Structured Streaming."""
