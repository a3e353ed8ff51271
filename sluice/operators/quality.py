"""Row-quality validation.

Rules are data: each :class:`Rule` compiles to one boolean Column that is
true when the row violates it. NULL never silently passes: every predicate is
wrapped as ``coalesce(violated, true)``, so a missing value violates a
membership rule, and a NULL list violates both "not blank" and "allowed
values" (two findings, as the row-by-row checker reports).

All findings of a row come from one projection in one pass:
``filter(array(when(rule_i, finding_i) ...), x -> x IS NOT NULL)``, no join,
no shuffle; ``violations`` explodes that array into one row per finding, in
rule order within the row.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from ..functions.text import is_blank, split_strip

FINDINGS = "_violations"


@dataclass(frozen=True)
class Rule:
    """One validation rule.

    kind:
      ``not_blank``  value is NULL, empty or whitespace only (F2)
      ``each_in``    every element of the comma list, stripped, is in
                     ``allowed`` (case-sensitive); reports offenders (F3)
      ``in_ci``      lower(value) in lower(allowed), value not stripped (F4)
      ``in_upper``   upper(value) in upper(allowed), value not stripped (F5)
      ``equals``     value == allowed[0], case-sensitive (F1)
      ``expr``       ``predicate`` (a Column, true = violation)
    """

    id: str
    column: str
    kind: str
    allowed: tuple = ()
    sep: str = ","
    message: str | None = None
    predicate: Column | None = field(default=None, compare=False)


def _c(name: str) -> Column:
    return F.col(f"`{name}`")


def _violated(rule: Rule) -> tuple[Column, Column]:
    """(violation predicate, offending text) for one rule."""
    v = _c(rule.column)
    if rule.kind == "not_blank":
        return is_blank(v), F.lit(None).cast("string")
    if rule.kind == "each_in":
        elems = split_strip(v, rule.sep)
        allowed = F.array(*[F.lit(a) for a in rule.allowed])
        bad = F.filter(elems, lambda x: ~F.array_contains(allowed, x))
        # NULL list: one offending (missing) element, whatever size(NULL) gives.
        cond = v.isNull() | F.coalesce(F.size(bad) > 0, F.lit(True))
        return cond, F.coalesce(F.array_join(bad, ", ", "NULL"), F.lit("NULL"))
    if rule.kind == "in_ci":
        cond = ~F.lower(v).isin([a.lower() for a in rule.allowed])
        return F.coalesce(cond, F.lit(True)), v
    if rule.kind == "in_upper":
        cond = ~F.upper(v).isin([a.upper() for a in rule.allowed])
        return F.coalesce(cond, F.lit(True)), v
    if rule.kind == "equals":
        return F.coalesce(v != F.lit(rule.allowed[0]), F.lit(True)), v
    if rule.kind == "expr":
        return F.coalesce(rule.predicate, F.lit(True)), v.cast("string")
    raise ValueError(f"unknown rule kind {rule.kind!r}")


def _default_message(rule: Rule) -> str:
    if rule.kind == "not_blank":
        return f"{rule.column} is empty"
    if rule.kind == "each_in":
        return f"Invalid {rule.column} value(s)"
    if rule.kind in ("in_ci", "in_upper", "equals"):
        return f"Invalid {rule.column}; must be one of: {', '.join(rule.allowed)}"
    return f"{rule.id} failed"


def findings(rules: Sequence[Rule]) -> Column:
    """``array<struct<rule_pos, rule_id, column, offending, message>>`` of
    the rules a row violates, in rule order (empty array when clean)."""
    items, any_bad = [], F.lit(False)
    for pos, r in enumerate(rules):
        cond, offending = _violated(r)
        item = F.struct(
            F.lit(pos).alias("rule_pos"), F.lit(r.id).alias("rule_id"),
            F.lit(r.column).alias("column"), offending.cast("string").alias("offending"),
            F.lit(r.message or _default_message(r)).alias("message"))
        items.append(F.when(cond, item))
        any_bad = any_bad | cond
    # Clean rows, the most, build no findings.
    found = F.filter(F.array(*items), lambda x: x.isNotNull())
    return F.when(any_bad, found).otherwise(F.filter(F.array(*items[:1]), lambda x: F.lit(False)))


def elements_not_in(df: DataFrame, row_id: str, column: str, reference: DataFrame, ref_column: str,
                    sep: str = ",") -> DataFrame:
    """F3 against a table: (row_id, offending) for the rows whose list ``column``
    has an element, stripped, that is not in ``reference.ref_column``.

    The same findings as a rule of kind ``each_in`` with the table's values as
    ``allowed``: offenders in list order, repeats kept, a NULL list reported as
    one missing element. ``row_id`` must be unique. Elements are anti joined,
    so the reference may be of any size and a frequent element is a skewed
    partition that Spark can split; only rows with an offender are grouped again.
    """
    elements = df.select(_c(row_id).alias("row_id"),
                         F.posexplode_outer(split_strip(_c(column), sep)).alias("pos", "element"))
    known = reference.select(_c(ref_column).cast("string").alias("element")).dropna().distinct()
    bad = elements.join(known, "element", "left_anti")
    in_order = F.transform(F.array_sort(F.collect_list(F.struct("pos", "element"))), lambda x: x["element"])
    return (bad.groupBy("row_id").agg(in_order.alias("e"))
            .select("row_id", F.array_join("e", ", ", "NULL").alias("offending")))


def flag(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """V3 (step 1): add the findings array once."""
    return df.withColumn(FINDINGS, findings(rules))


def violations(df: DataFrame, rules: Sequence[Rule], row_id: str | Column) -> DataFrame:
    """V1: one output row per (row, violated rule)."""
    rid = F.col(row_id) if isinstance(row_id, str) else row_id
    return (df.select(rid.alias("row_id"), F.explode(findings(rules)).alias("f"))
            .select("row_id", "f.rule_pos", "f.rule_id", "f.column", "f.offending", "f.message"))


def split_valid(flagged: DataFrame) -> tuple[DataFrame, DataFrame]:
    """V3 (step 2): (valid rows, rejected rows with their findings)."""
    bad = F.size(F.col(FINDINGS)) > 0
    return flagged.filter(~bad).drop(FINDINGS), flagged.filter(bad)


def write_split(flagged: DataFrame, path: str, status_col: str = "quality") -> None:
    """V3 in one pass: valid and rejected rows land in the ``valid`` and
    ``rejected`` partitions of one table by a single job (one scan of the
    input, no cache), rejected rows with their findings."""
    bad = F.size(F.col(FINDINGS)) > 0
    (flagged.withColumn(status_col, F.when(bad, F.lit("rejected")).otherwise(F.lit("valid")))
     .write.mode("overwrite").partitionBy(status_col).parquet(path))


class ValidationError(ValueError):
    """``findings`` (from ``gate``) has every finding as a DataFrame."""

    findings: DataFrame | None = None


def gate(df: DataFrame, rules: Sequence[Rule], row_id: str | Column, show: int = 20,
         findings_path: str | None = None) -> None:
    """V2: raise before any write when any row violates any rule.

    The exception carries every finding as a DataFrame; with
    ``findings_path`` they are first written there as Parquet. The message
    itself quotes the first ``show``.
    """
    found = violations(df, rules, row_id)
    n = found.count()
    if not n:
        return
    if findings_path is not None:
        found.write.mode("overwrite").parquet(findings_path)
        found = df.sparkSession.read.schema(found.schema).parquet(findings_path)
    sample = found.orderBy("row_id", "rule_pos").limit(show).collect()
    lines = [f"Row {r.row_id}: {r.message}" + (f" [{r.offending}]" if r.offending else "")
             for r in sample]
    more = f"\n... {n - len(sample)} more" if n > len(sample) else ""
    if findings_path is not None:
        more += f"\nAll findings: {findings_path}"
    error = ValidationError(f"{n} validation finding(s):\n" + "\n".join(lines) + more)
    error.findings = found
    raise error


def observe_quality(flagged: DataFrame, name: str = "quality") -> tuple[DataFrame, Observation]:
    """V4: rows seen / rows bad, collected in the same pass as the next action."""
    obs = Observation(name)
    out = flagged.observe(
        obs, F.count(F.lit(1)).alias("rows_seen"),
        F.count_if(F.size(F.col(FINDINGS)) > 0).alias("rows_bad"))
    return out, obs


def require_columns(df: DataFrame, required: Sequence[str]) -> None:
    """Fail naming every missing column (plan-time, no job)."""
    missing = [c for c in required if c not in df.columns]
    if missing:
        raise ValidationError(f"Missing required columns: {missing}")


def require_rows(df: DataFrame, what: str = "input") -> None:
    """S3: fail on empty input (a LIMIT 1 job)."""
    if df.isEmpty():
        raise ValidationError(f"{what} is empty")
