"""Incremental ingest of arriving files."""
