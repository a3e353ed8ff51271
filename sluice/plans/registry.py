"""Named query registry: each entry is ``(spark, sf_dir) -> DataFrame`` plus,
where the semantics are expressible in SQL, the equivalent DuckDB SQL over
the same tables (used as the correctness oracle)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QueryFn = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, QueryFn] = {}
ORACLE: dict[str, str] = {}
OPERATORS: dict[str, tuple[str, ...]] = {}


def query(name: str, ops: tuple[str, ...], sql: str | None = None):
    """Register ``fn`` under ``name``; ``ops`` lists the SURVEY operator ids covered."""
    def wrap(fn: QueryFn) -> QueryFn:
        QUERIES[name] = fn
        OPERATORS[name] = ops
        if sql is not None:
            ORACLE[name] = sql.strip()
        return fn
    return wrap
