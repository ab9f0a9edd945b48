"""Registry of the queries exposed through ``__spark_entry__``.

Each entry is a callable ``(spark, sf_dir) -> DataFrame`` and, where SQL can express it, the
equivalent DuckDB SQL over the driver's pre-registered views. Column names match between both.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QueryFn = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, QueryFn] = {}
ORACLE: dict[str, str] = {}
DOCS: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    """Register ``fn`` under ``name`` with an optional oracle SQL string."""
    def deco(fn: QueryFn) -> QueryFn:
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = fn
        DOCS[name] = (fn.__doc__ or "").strip()
        if sql is not None:
            ORACLE[name] = sql.strip()
        return fn
    return deco


def load_all() -> tuple[dict[str, QueryFn], dict[str, str]]:
    """Import every catalogue module (they register on import) and return the registries."""
    from hourloom.plans import catalog  # noqa: F401
    return QUERIES, ORACLE
