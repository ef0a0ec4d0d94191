"""Structured Streaming ingest and live windows."""
