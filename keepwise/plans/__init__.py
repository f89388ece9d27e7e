"""Registered queries with their DuckDB oracle SQL, end-to-end jobs and SQL views."""
