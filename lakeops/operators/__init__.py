"""Relational operators: control scan, reconciliation, audit, ingestion, maintenance."""
