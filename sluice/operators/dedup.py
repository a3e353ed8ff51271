"""Keyed deduplication: first row per key (A1) and latest row per key (A3).

Both are ``row_number() = 1`` over a window. Spark plans that as a *partial*
WindowGroupLimit before the shuffle and a final one after it, so every map
task reduces each key to one row before anything is shuffled: a hot key that
holds a third of the rows costs one row per map task in the exchange, not a
third of the data in one reducer. The ordering is always made total (the
remaining orderable columns are appended as tie-breaks), so the surviving row
does not depend on task scheduling or retries.

``strategy="agg"`` uses ``min_by``/``max_by`` over a struct instead (partial
+ final SortAggregate); measured faster when keys are few.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, MapType, StructType

_RN = "__sluice_rn"


def _orderable(df: DataFrame, exclude: Sequence[str]) -> list[str]:
    out = []
    for f in df.schema.fields:
        if f.name in exclude:
            continue
        if isinstance(f.dataType, MapType):
            continue
        if isinstance(f.dataType, (ArrayType, StructType)) and "map<" in f.dataType.simpleString():
            continue
        out.append(f.name)
    return out


def _resolve(df: DataFrame, cols: Sequence[str | Column]) -> list[Column]:
    return [F.col(c) if isinstance(c, str) else c for c in cols]


def _total_order(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column],
                 descending: bool) -> list[Column]:
    named = [c for c in order if isinstance(c, str)]
    ties = [F.col(c) for c in _orderable(df, list(keys) + named)]
    if descending:
        return [c.desc_nulls_last() for c in _resolve(df, order) + ties]
    # Tie-break columns treat NULL as the lowest value (as max/min_by do).
    return [c.asc_nulls_last() for c in _resolve(df, order)] + [c.asc_nulls_first() for c in ties]


def _top1(df: DataFrame, keys: Sequence[str | Column], order_cols: list[Column]) -> DataFrame:
    w = Window.partitionBy(*_resolve(df, keys)).orderBy(*order_cols)
    return df.withColumn(_RN, F.row_number().over(w)).filter(F.col(_RN) == 1).drop(_RN)


def latest_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column],
                   strategy: str = "window") -> DataFrame:
    """A3: the row with the greatest ``order`` tuple per key.

    NULL ordering values sort lowest. Ties on ``order`` are broken by the
    other columns (descending), so the result is deterministic.
    """
    if strategy == "agg":
        return _by_agg(df, keys, order, pick_max=True)
    return _top1(df, keys, _total_order(df, keys, order, descending=True))


def first_per_key(df: DataFrame, keys: Sequence[str | Column], order: Sequence[str | Column],
                  strategy: str = "window") -> DataFrame:
    """A1: the row with the smallest ``order`` tuple per key ("first in input
    order" when ``order`` is the input position). ``keys`` may be expressions,
    e.g. ``lower(col)`` for a case-insensitive key.
    """
    if strategy == "agg":
        return _by_agg(df, keys, order, pick_max=False)
    named_keys = [k for k in keys if isinstance(k, str)]
    return _top1(df, keys, _total_order(df, named_keys, order, descending=False))


def _by_agg(df: DataFrame, keys: Sequence[str | Column], order: Sequence[str | Column],
            pick_max: bool) -> DataFrame:
    # Ordering wrapped in a struct: bare-column min_by/max_by skip NULL orderings.
    named_keys = [k for k in keys if isinstance(k, str)]
    named_order = [c for c in order if isinstance(c, str)]
    ties = _orderable(df, named_keys + named_order)
    tie_cols = [F.col(c) for c in ties]
    row = F.struct(*[F.col(c) for c in df.columns])
    pick = F.max_by if pick_max else F.min_by
    if pick_max:
        # Struct ordering puts NULL fields lowest: max skips them, as wanted.
        ord_struct = F.struct(*_resolve(df, order), *tie_cols)
    else:
        # min would pick a NULL order value first; a flat (is_null, value)
        # pair per order column sorts NULL after values (tie-break columns
        # keep NULL lowest). Flat, not nested: nested structs compare
        # several times slower.
        ord_struct = F.struct(*[e for x in _resolve(df, order) for e in (x.isNull(), x)],
                              *tie_cols)
    key_cols = [(F.col(k) if isinstance(k, str) else k).alias(f"__k{i}") for i, k in enumerate(keys)]
    return (df.groupBy(*key_cols).agg(pick(row, ord_struct).alias("__row"))
            .select("__row.*"))
