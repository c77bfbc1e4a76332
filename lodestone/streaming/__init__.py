"""Structured Streaming jobs: continuous ingestion and event assembly."""
