"""Incremental ingestion of new files."""
