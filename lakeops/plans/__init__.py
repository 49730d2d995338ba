"""Registered queries (with DuckDB twins) and the fixtures they derive from the test tables."""
