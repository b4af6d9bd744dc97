"""Structured Streaming variant of incremental ingestion."""
