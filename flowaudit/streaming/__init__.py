"""Incremental ingest: the batch flow schema on a Structured Streaming file source."""
