"""Readers: lake tables, Spark-side extracts, JDBC databases, dropped files."""
