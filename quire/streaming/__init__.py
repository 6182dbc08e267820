"""Structured Streaming ingest: new book files are indexed as they land."""
