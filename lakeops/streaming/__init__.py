"""Structured Streaming jobs: incremental, exactly-once file-drop ingestion."""
