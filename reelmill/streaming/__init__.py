"""Structured Streaming ingest of viewing events."""
