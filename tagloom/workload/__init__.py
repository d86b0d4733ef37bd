"""The registered queries over the given tables, with SQL twins for DuckDB."""
