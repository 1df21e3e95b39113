"""Structured Streaming twins of ingest, deduplication and the daily rollup."""
