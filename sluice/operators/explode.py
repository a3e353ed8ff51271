"""Fan-out of comma lists (X1) and per-row name lists.

All are narrow (no shuffle): ``posexplode`` and higher-order array functions
run inside the scan's stage.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import col_, split_literal, split_strip


def explode_list(df: DataFrame, column: str, sep: str = ",", strip: bool = True,
                 value_col: str | None = None, pos_col: str = "pos") -> DataFrame:
    """One row per list element, position from 0, duplicates and order kept.

    ``strip`` trims every element with Python ``strip`` semantics. A NULL list
    yields no row (validation rejects such rows before fan-out).
    """
    value_col = value_col or column
    arr = split_strip(column, sep) if strip else split_literal(column, sep)
    others = [F.col(f"`{c}`") for c in df.columns if c != value_col]
    return df.select(*others, F.posexplode(arr).alias(pos_col, value_col))


def per_row_list(list_col: Column | str, fn: Callable[[Column], Column], sep: str = ",",
                 strip: bool = True) -> Column:
    """A4: the list of names a row produces, computed in place (no explode,
    no regroup): ``[fn(x) for x in s.split(sep)]``."""
    arr = split_strip(list_col, sep) if strip else split_literal(list_col, sep)
    return F.transform(arr, fn)


def zip_lists(a: Column | str, b: Column | str) -> Column:
    """Positional pairing of two parallel lists (``a[i]`` with ``b[i]``)."""
    return F.arrays_zip(col_(a), col_(b))
