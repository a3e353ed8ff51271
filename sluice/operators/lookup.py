"""Lookup joins: first match wins (J1), misses (J2), insert-if-absent (J3),
key guard (F6).

Nothing runs while a plan is built: whether a side is broadcast is the
planner's decision, from its size estimate or, at run time, from measured
bytes (``spark.sql.autoBroadcastJoinThreshold``); all else is a shuffle join
whose skewed partitions AQE splits.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import is_blank
from .dedup import first_per_key

def _keys(k: str | Sequence[str]) -> list[str]:
    return [k] if isinstance(k, str) else list(k)


def lookup(left: DataFrame, right: DataFrame, left_key: str | Sequence[str],
           right_key: str | Sequence[str], order: Sequence[str | Column], values: Sequence[str],
           hit_col: str | None = None, right_is_unique: bool = False) -> DataFrame:
    """Left join to the first matching right row (case-sensitive key,
    single or composite).

    ``right`` is reduced to one row per key first (A1), so the join never
    multiplies left rows; ``right_is_unique`` says that it already is.
    """
    lks, rks = _keys(left_key), _keys(right_key)
    present = F.lit(True)
    for k in rks:
        present = present & F.col(k).isNotNull()
    r = right.filter(present)
    if not right_is_unique:
        r = first_per_key(r, rks, order)
    cols = [F.col(k).alias(f"__lk{i}") for i, k in enumerate(rks)] + [F.col(v) for v in values]
    if hit_col:
        cols.append(F.lit(True).alias(hit_col))
    r = r.select(*cols)
    cond = None
    for i, k in enumerate(lks):
        c = left[k] == r[f"__lk{i}"]
        cond = c if cond is None else cond & c
    out = left.join(r, cond, "left").drop(*[f"__lk{i}" for i in range(len(rks))])
    if hit_col:
        out = out.withColumn(hit_col, F.coalesce(F.col(hit_col), F.lit(False)))
    return out


def lookup_misses(left: DataFrame, right: DataFrame, left_key: str | Sequence[str],
                  right_key: str | Sequence[str], few_left: bool = False) -> DataFrame:
    """Left rows without a match (a NULL key matches nothing).

    ``few_left``: the left side is expected to be far smaller than the right
    one. The right keys are then first reduced to those that occur on the
    left, by a semi join in which the planner can broadcast the left keys, so
    the big side is not shuffled; if it cannot, the result is the same.
    """
    lks, rks = _keys(left_key), _keys(right_key)
    names = [f"__rk{i}" for i in range(len(rks))]
    keys = right.select(*[F.col(k).alias(n) for k, n in zip(rks, names, strict=True)]).dropna()
    if few_left:
        keys = keys.join(left.select(*[F.col(k).alias(n) for k, n in zip(lks, names, strict=True)]),
                         names, "left_semi")
    keys = keys.distinct()
    cond = None
    for i, k in enumerate(lks):
        c = left[k] == keys[f"__rk{i}"]
        cond = c if cond is None else cond & c
    return left.join(keys, cond, "left_anti")


def key_guard(key: Column | str) -> Column:
    """true when a lookup key is usable (present and not blank)."""
    return ~is_blank(key)


def insert_if_absent(existing: DataFrame, incoming: DataFrame, keys: Sequence[str],
                     order: Sequence[str | Column]) -> DataFrame:
    """The incoming rows to append: one per key, only for keys not yet in
    ``existing``. Appending the result keeps the table duplicate-free across
    re-runs."""
    keys = list(keys)
    fresh = first_per_key(incoming, keys, order)
    names = [f"__k{i}" for i in range(len(keys))]

    def same(a: DataFrame, b: DataFrame, b_keys: Sequence[str]) -> Column:
        cond = F.lit(True)  # NULL is a key value like any other
        for k, n in zip(b_keys, names, strict=True):
            cond = cond & b[k].eqNullSafe(a[n])
        return cond

    have = existing.select(*[F.col(k).alias(n) for k, n in zip(keys, names, strict=True)])
    # Incoming rows are few against the table: its keys are reduced to those
    # that matter inside its own scan, where the planner broadcasts the few.
    have = have.join(fresh.select(*keys), same(have, fresh, keys), "left_semi").distinct()
    return fresh.join(have, same(have, fresh, keys), "left_anti")
