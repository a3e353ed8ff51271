"""Code mapping and label functions (P9-P12) as column expressions."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import fixed
from .text import col_


def map_code(c: Column | str, mapping: Mapping[str, str], default: str | None) -> Column:
    """``mapping.get(c, default)``; NULL and unknown codes get the default.

    The map literal is a constant folded into the plan (no join, no shuffle).
    """
    pairs = [F.lit(x) for kv in mapping.items() for x in kv]
    looked = F.try_element_at(F.create_map(*pairs), col_(c))
    return F.coalesce(looked, F.lit(default))


def lower_or_default(c: Column | str, default: str) -> Column:
    """``d.get(k, default).lower()``."""
    return F.lower(F.coalesce(col_(c), F.lit(default)))


def refresh_label(load_type: Column | str) -> Column:
    """P10: ``"incremental load"`` for ``inc``, else ``"<type> load"``.

    The argument is expected lower-cased already (as P11 produces).
    """
    lt = col_(load_type)
    return F.when(lt == F.lit("inc"), F.lit(fixed.INC_LABEL)).otherwise(
        F.concat(lt, F.lit(" load")))


def account_suffix(sensitivity: Column | str) -> Column:
    """P9 applied to the sensitivity code."""
    return map_code(
        lower_or_default(sensitivity, fixed.DEFAULT_SENSITIVITY),
        fixed.SENSITIVITY_ACCOUNT_SUFFIX, fixed.SENSITIVITY_ACCOUNT_DEFAULT)


def service_account(suffix: Column | str, env: Column | str, template: str) -> Column:
    """Fill ``{suffix}`` and ``{env}`` placeholders of an account template."""
    out = F.lit(template)
    out = F.replace(out, F.lit("{suffix}"), col_(suffix))
    return F.replace(out, F.lit("{env}"), col_(env))
