"""Incremental loads, automatic ingestion and change consumption."""
