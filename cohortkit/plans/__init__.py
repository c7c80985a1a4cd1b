"""Registered queries (Spark plan + DuckDB oracle SQL) over the test tables."""
