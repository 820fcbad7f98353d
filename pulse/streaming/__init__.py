"""Structured Streaming forms of ingestion, de-duplication and activity."""
