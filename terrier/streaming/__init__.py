"""Incremental ingestion of chunk files."""
