"""Structured Streaming ingest of JSON records."""
