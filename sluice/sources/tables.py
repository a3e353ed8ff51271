"""Table sources: Parquet tables by name, raw extracts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, root: str, name: str) -> DataFrame:
    """``<root>/<name>.parquet`` as a DataFrame (filters and projections
    applied later are pushed into the scan by Catalyst)."""
    return spark.read.parquet(f"{root.rstrip('/')}/{name}.parquet")


def ts_ntz(text: str) -> Column:
    """A ``timestamp_ntz`` literal (the test tables store timestamps without zone)."""
    return F.expr(f"TIMESTAMP_NTZ '{text}'")


def extract_raw(source: DataFrame, item_filter: Column | None, columns: Sequence[str] | None,
                load_ts: Column, item_cols: dict[str, Column] | None = None) -> DataFrame:
    """The slice of a source table that belongs to one work item.

    ``item_filter`` and ``columns`` reach the scan (pushdown, pruning); the
    load timestamp is one run-scoped literal (K8), not ``current_timestamp``
    per task, so retried tasks write the same value.
    """
    df = source if item_filter is None else source.filter(item_filter)
    if columns is not None:
        df = df.select(*columns)
    extra = [c.alias(n) for n, c in (item_cols or {}).items()]
    return df.select("*", *extra, load_ts.alias("ds_load_ts"))
