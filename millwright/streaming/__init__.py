"""Structured Streaming versions of the ingestion, health and alert jobs."""
