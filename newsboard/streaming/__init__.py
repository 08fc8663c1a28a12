"""Structured Streaming forms of ingest, counting and routing."""
