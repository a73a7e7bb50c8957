"""Structured Streaming forms: bounded ingest, delivery markers and upserts."""
