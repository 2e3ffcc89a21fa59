"""Independent DuckDB SQL for every registered query (the correctness oracle)."""

from .sql import oracle_sql

__all__ = ["oracle_sql"]
