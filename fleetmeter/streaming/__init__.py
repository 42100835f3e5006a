"""Structured Streaming ingest and its health checks."""
