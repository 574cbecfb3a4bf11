"""Registry of named queries: a Spark builder and, where SQL can express it,
the DuckDB oracle text, declared side by side."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession

from . import oracle

QueryFn = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, QueryFn] = {}


def query(name: str, fixtures: Sequence[str] | None = None, sql: str | None = None):
    """Register ``fn(spark, sf_dir) -> DataFrame`` under ``name``; ``sql`` is the
    DuckDB oracle (prefixed with the named fixture views)."""
    def deco(fn: QueryFn) -> QueryFn:
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = fn
        if sql is not None:
            oracle.register(name, fixtures, sql)
        return fn
    return deco


def all_queries() -> dict[str, QueryFn]:
    from . import catalog  # noqa: F401  (registers on import)
    return dict(QUERIES)


def all_sql() -> dict[str, str]:
    from . import catalog  # noqa: F401
    return dict(oracle.SQL)
