"""Registered queries and their independent DuckDB counterparts."""
