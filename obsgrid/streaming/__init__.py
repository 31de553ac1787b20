"""Incremental refresh: work plans, gates, publishing and streaming ingestion."""
