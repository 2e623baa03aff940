"""Structured Streaming forms of ingestion."""
