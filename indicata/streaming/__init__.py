"""Structured Streaming ingestion of submission folders."""
