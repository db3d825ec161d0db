"""Independent SQL for every registered query, for DuckDB over the same files."""

from oracle.queries import oracle_sql

__all__ = ["oracle_sql"]
