"""Training-data pipeline operators and their registered queries.

Nothing outside this subpackage imports it; ``registry.QUERIES`` lists the
queries and ``registry.ORACLE_SQL`` the DuckDB text of those SQL can express."""
