"""Per-item outcomes (C1) and run summary.

A failed item does not stop the others: each item row carries
``status`` (``ok`` / ``error``) and ``error`` text computed relationally, and
success and failure are two filters of one DataFrame. The summary is a tiny
aggregate (partial counts per map task, a handful of groups after the shuffle).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

OK = "ok"
ERROR = "error"


def outcome(checks: Sequence[tuple[Column, str, Column]]) -> tuple[Column, Column, Column]:
    """First failing check wins.

    ``checks``: ``(failed, error_class, message)`` in priority order.
    Returns ``(status, error_class, error)`` columns.
    """
    status = F.lit(OK)
    cls = F.lit(None).cast("string")
    msg = F.lit(None).cast("string")
    for failed, klass, text in reversed(list(checks)):
        failed = F.coalesce(failed, F.lit(True))
        status = F.when(failed, F.lit(ERROR)).otherwise(status)
        cls = F.when(failed, F.lit(klass)).otherwise(cls)
        msg = F.when(failed, text).otherwise(msg)
    return status.alias("status"), cls.alias("error_class"), msg.alias("error")


def with_outcome(df: DataFrame, checks: Sequence[tuple[Column, str, Column]]) -> DataFrame:
    status, cls, msg = outcome(checks)
    return df.select("*", status, cls, msg)


def run_summary(items: DataFrame, group: Sequence[str] = ("status", "error_class")) -> DataFrame:
    """Item count per status and error class."""
    return items.groupBy(*group).agg(F.count(F.lit(1)).alias("items"))


def counts(df: DataFrame, **conditions: Column) -> DataFrame:
    """A2: one row with ``rows`` and a ``count_if`` per named condition."""
    aggs = [F.count(F.lit(1)).alias("rows")]
    aggs += [F.count_if(F.coalesce(c, F.lit(False))).alias(n) for n, c in conditions.items()]
    return df.agg(*aggs)
