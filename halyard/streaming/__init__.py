"""Structured Streaming forms of ingest, consolidation and upsert."""
