"""Registered queries over the test tables (Spark) and their DuckDB oracles."""
