"""Incremental ingest: the file is the unit of change."""
