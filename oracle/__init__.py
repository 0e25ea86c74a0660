"""Independent SQL for DuckDB: what every registered query has to return."""

from oracle.catalog import ORACLE_SQL

__all__ = ["ORACLE_SQL"]
