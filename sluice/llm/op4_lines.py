"""Line deduplication by overlapping three-line windows, in DataFrame functions only.

Lines are the ``\\n``-separated parts of a text that hold a word; blank lines
take no part and stay. Every run of three consecutive lines is a window with
a 128-bit hash. A window that occurs again, in the same or another document,
is removed at every place but its first (smallest document id, then text hash,
then position); the lines covered by such windows are merged and cut out.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sluice.llm._stage import staged

WINDOW = 3
_WORD = "[^\\x20\\x09-\\x0D]"


def _numbered_lines(text: Column) -> Column:
    """(index in the text, line) of every line with a word."""
    lines = F.transform(F.split(text, "\n", -1), lambda l, i: F.struct(i.alias("i"), l.alias("l")))
    return F.filter(lines, lambda x: x["l"].rlike(_WORD))


def line_windows(docs: DataFrame) -> DataFrame:
    """(doc_id, h, j, k1, k2, covers) per window; ``docs`` has doc_id, h, text."""
    starts = F.when(F.size("n") >= WINDOW, F.sequence(F.lit(0), F.size("n") - WINDOW)).otherwise(
        F.array().cast("array<int>"))

    def window(j: Column) -> Column:
        lines = [F.get("n", j + k)["l"] for k in range(WINDOW)]
        return F.struct(j.alias("j"), F.xxhash64(*lines).alias("k1"),
                        F.xxhash64(F.lit(WINDOW), *reversed(lines)).alias("k2"),
                        F.array(*[F.get("n", j + k)["i"] for k in range(WINDOW)]).alias("covers"))

    return (docs.select("doc_id", "h", _numbered_lines(F.col("text")).alias("n"))
            .select("doc_id", "h", F.explode(F.transform(starts, window)).alias("w"))
            .select("doc_id", "h", "w.*"))


def repeated_lines(docs: DataFrame) -> DataFrame:
    """(doc_id, h, removed): indexes of the lines to cut, merged per document."""
    windows = line_windows(docs)
    place = F.struct("doc_id", "h", "j")
    # Written, so that both sides of the join below are plain exchanges whose
    # skewed parts (a passage in a third of all documents) Spark can split.
    first = staged(windows.groupBy("k1", "k2").agg(F.min(place).alias("first"), F.count("*").alias("n"))
                   .filter("n > 1").select("k1", "k2", "first"), "first_windows")
    return (windows.join(first, ["k1", "k2"]).filter(place != F.col("first"))
            .groupBy("doc_id", "h").agg(F.array_distinct(F.flatten(F.collect_list("covers"))).alias("removed")))


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with the repeated windows cut out of ``text_col``, plus ``n_lines``
    (lines before) and ``n_removed_lines``.

    Null texts stay null and empty texts empty, with 0 and 1 lines. Rows
    without an id take no part and stay as they are. Rows that repeat both id
    and text are treated alike; a window that such rows share at the same
    place counts as one first occurrence. A text with fewer than three lines
    has no window. Other columns pass through; an input column named like one
    of the two added ones is replaced.
    """
    keep = [c for c in docs.columns if c not in ("n_lines", "n_removed_lines")]
    text = F.col(f"`{text_col}`")
    # The text travels as its lines: they are split once, below the join, and
    # joined again give exactly the text.
    packed = docs.select(
        F.struct(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(keep) if c != text_col],
                 F.lit(0).alias("none")).alias("rest"),
        F.col(f"`{id_col}`").alias("doc_id"), F.xxhash64(text).alias("h"), F.split(text, "\n", -1).alias("lines"))
    cut = repeated_lines(docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.xxhash64(text).alias("h"),
                                     text.alias("text")).filter("doc_id is not null and text is not null"))
    all_lines = F.sequence(F.lit(0), F.size("lines") - 1)
    left = F.when(F.col("removed").isNull(), F.col("lines")).otherwise(
        F.transform(F.array_except(all_lines, F.col("removed")), lambda i: F.get("lines", i)))
    return (packed.join(cut, ["doc_id", "h"], "left")
            .withColumn("clean", F.array_join(left, "\n"))
            .select(*[(F.col("clean") if c == text_col else F.col(f"rest.c{i}")).alias(c)
                      for i, c in enumerate(keep)],
                    F.when(F.col("lines").isNull(), 0).otherwise(F.size("lines")).cast("long").alias("n_lines"),
                    F.coalesce(F.size("removed"), F.lit(0)).cast("long").alias("n_removed_lines")))


ORACLE = r"""
WITH l AS (
  SELECT doc_id, unnest(string_split(text, chr(10))) AS l, generate_subscripts(string_split(text, chr(10)), 1) AS i
  FROM documents),
n AS (SELECT doc_id, l, i, row_number() OVER (PARTITION BY doc_id ORDER BY i) AS j
      FROM l WHERE regexp_matches(l, '[^\x20\x09-\x0D]')),
w AS (SELECT doc_id, j, l AS a, lead(l, 1) OVER d AS b, lead(l, 2) OVER d AS c
      FROM n WINDOW d AS (PARTITION BY doc_id ORDER BY j)),
r AS (SELECT doc_id, j, row_number() OVER (PARTITION BY a, b, c ORDER BY doc_id, j) AS seen
      FROM w WHERE c IS NOT NULL),
cut AS (SELECT DISTINCT doc_id, j + k AS j FROM r, (VALUES (0), (1), (2)) t(k) WHERE seen > 1),
gone AS (SELECT n.doc_id, n.i FROM n JOIN cut USING (doc_id, j)),
kept AS (SELECT l.doc_id, count(*) AS n_lines, count(g.i) AS n_removed_lines,
                coalesce(string_agg(l.l, chr(10) ORDER BY l.i) FILTER (WHERE g.i IS NULL), '') AS text
         FROM l LEFT JOIN gone g ON l.doc_id = g.doc_id AND l.i = g.i GROUP BY l.doc_id)
SELECT d.doc_id, coalesce(k.n_lines, 0) AS n_lines, coalesce(k.n_removed_lines, 0) AS n_removed_lines,
       CASE WHEN d.text IS NULL THEN NULL ELSE k.text END AS text
FROM documents d LEFT JOIN kept k USING (doc_id)
"""
