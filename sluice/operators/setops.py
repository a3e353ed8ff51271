"""Set operations: union by name (U1) and column-set difference."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from functools import reduce

from pyspark.sql import DataFrame


def union_by_name(frames: Iterable[DataFrame], allow_missing: bool = True) -> DataFrame:
    """UNION ALL matched by column name; a column missing on one side is
    NULL there. No shuffle (a plain Union of the inputs' partitions)."""
    frames = list(frames)
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=allow_missing), frames)


def missing_columns(df: DataFrame, required: Sequence[str]) -> list[str]:
    """Required minus present, in required order (plan-time, no job)."""
    have = set(df.columns)
    return [c for c in required if c not in have]
