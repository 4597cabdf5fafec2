"""Names of registered queries, and their SQL."""

from __future__ import annotations

QUERIES: dict = {}
ORACLE_SQL: dict[str, str] = {}


def query(sql: str | None = None):
    """Register a function ``(spark, folder) → DataFrame`` under its name, with its DuckDB SQL where there is one."""

    def keep(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLE_SQL[f.__name__] = sql
        return f

    return keep
