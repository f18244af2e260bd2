"""Query registry: name -> Spark callable ``(spark, sf_dir) -> DataFrame`` and, where the
result is expressible in SQL, the DuckDB oracle over the same driver tables.

Query functions live in the ``q_*`` modules of this package and register themselves here.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QueryFn = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, QueryFn] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn: QueryFn) -> QueryFn:
        if name in QUERIES:
            raise ValueError(f"query {name} registered twice")
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


def load_all() -> None:
    """Import every query module so that the registry is filled."""
    from wordloom.plans import (  # noqa: F401
        q_text, q_stats, q_sources, q_cells, q_features, q_scoring, q_models, q_stream,
    )


def queries() -> dict[str, QueryFn]:
    load_all()
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    load_all()
    return dict(ORACLE)
