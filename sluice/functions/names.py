"""Name derivation for work items (P3-P8) as column expressions.

``concat`` is used on purpose: a NULL part makes the whole name NULL, which
the item outcome turns into an error, instead of ``concat_ws`` silently
producing a wrong but plausible name.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import fixed
from .text import col_, part, prefix, py_strip, replace_literal, split_literal


def table_name(banner: Column | str, table: Column | str) -> Column:
    """``<banner stripped, lower>_<table lower>``."""
    return F.concat(F.lower(py_strip(banner)), F.lit("_"), F.lower(col_(table)))


def cluster_name(schema: Column | str, banner: Column | str, table: Column | str) -> Column:
    """``<schema>-<banner>-<table>``, lower; ``_`` -> ``-`` in schema and
    table only (the banner keeps its characters)."""
    return F.concat(
        replace_literal(F.lower(col_(schema)), "_", "-"), F.lit("-"),
        F.lower(py_strip(banner)), F.lit("-"),
        replace_literal(F.lower(col_(table)), "_", "-"),
    )


def unit_name(banner: Column | str, load_type: Column | str, schema: Column | str,
              table: Column | str, unit_prefix: str = fixed.UNIT_PREFIX) -> Column:
    """P5: ``<prefix>-SA<banner>-<load>-<SCHEMA>-<banner>_<table>``."""
    b = col_(banner)
    return F.concat(
        F.lit(unit_prefix + "-" + fixed.UNIT_DIVISION_PREFIX), b, F.lit("-"),
        col_(load_type), F.lit("-"), F.upper(col_(schema)), F.lit("-"),
        b, F.lit("_"), col_(table),
    )


def decode_unit_name(name: Column | str) -> Column:
    """Inverse of ``unit_name``.

    Returns ``struct(ok, banner, load_type, schema, table)``. A name that does
    not split into exactly five ``-`` parts, or whose parts are inconsistent
    with the encoding, gives ``ok = false`` and NULL fields (never an error).
    """
    parts = split_literal(name, "-")
    div = part(parts, 1)
    last = part(parts, 4)
    banner = F.substr(div, F.lit(len(fixed.UNIT_DIVISION_PREFIX) + 1))
    ok = (
        (F.size(parts) == F.lit(fixed.UNIT_PARTS))
        & (prefix(div, len(fixed.UNIT_DIVISION_PREFIX)) == F.lit(fixed.UNIT_DIVISION_PREFIX))
        & F.startswith(last, F.concat(banner, F.lit("_")))
    )
    ok = F.coalesce(ok, F.lit(False))
    table = F.substr(last, F.length(banner) + 2)
    schema = part(parts, 3)
    return F.struct(
        ok.alias("ok"),
        F.when(ok, banner).alias("banner"),
        F.when(ok, part(parts, 2)).alias("load_type"),
        F.when(ok, schema).alias("schema"),
        F.when(ok, table).alias("table"),
    )


def output_dir(root: str, schema: Column | str, table: Column | str) -> Column:
    """``<root>/<schema>/<table_name>``."""
    return F.concat(F.lit(root.rstrip("/") + "/"), col_(schema), F.lit("/"), col_(table))


def lake_path(storage_id: Column | str, table: Column | str, scheme: str = "gs://") -> Column:
    """``<scheme><storage id>/<table_name>``."""
    return F.concat(F.lit(scheme), col_(storage_id), F.lit("/"), col_(table))


def tags(constants: Sequence[str], *cols: Column | str, trailing: Sequence[str] = ()) -> Column:
    """Array of constant tags, per-row values, and trailing constants."""
    return F.array(*[F.lit(t) for t in constants], *[col_(c) for c in cols], *[F.lit(t) for t in trailing])
