"""Sorted listing (O1), with positions, and preview (O2).

``preview`` is ORDER BY + LIMIT, planned as TakeOrderedAndProject: each task
keeps its own top ``n`` and only ``n x tasks`` rows reach the final merge.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import scratch_path

_ROW_BITS = 33  # monotonically_increasing_id: partition number above, row number below


def sorted_listing(df: DataFrame, by: Sequence[str | Column]) -> DataFrame:
    """O1: ascending lexical order (a range-partitioned global sort)."""
    return df.orderBy(*by)


def sorted_positions(df: DataFrame, by: Sequence[str | Column], name: str = "position") -> DataFrame:
    """O1 with the place of every row in the order, from 1.

    The rows are sorted over a range partition and written to the shared
    folder with (partition, row in it), so the numbers stay fixed when a task
    is repeated. One row per partition then gives every partition its offset;
    no task sees more than its own range. ``by`` should tell rows apart: rows
    equal in all of it fall into one partition, in no particular order.
    """
    spark = df.sparkSession
    at, part = "__sluice_at", "__sluice_part"
    path = scratch_path(spark, "positions")
    ranged = df.orderBy(*by).withColumn(at, F.monotonically_increasing_id())
    ranged.write.parquet(path)
    rows = spark.read.schema(ranged.schema).parquet(path).withColumn(part, F.shiftrightunsigned(at, _ROW_BITS))
    before = Window.orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    # One row per partition of the sort, whatever the data: hence the window and the broadcast.
    offsets = (rows.groupBy(part).agg(F.count(F.lit(1)).alias("__sluice_n"))
               .select(part, F.coalesce(F.sum("__sluice_n").over(before), F.lit(0)).alias("__sluice_off")))
    in_part = F.col(at).bitwiseAND(F.lit((1 << _ROW_BITS) - 1))
    return (rows.join(F.broadcast(offsets), part)
            .withColumn(name, F.col("__sluice_off") + in_part + F.lit(1))
            .select(*[F.col(f"`{c}`") for c in df.columns if c != name], name))


def preview(df: DataFrame, by: Sequence[str | Column], n: int = 5) -> DataFrame:
    """O2: first ``n`` rows in an explicit order (the limit is the feature)."""
    return df.orderBy(*by).limit(n)
