"""Incremental ingest and running figures with Structured Streaming."""
