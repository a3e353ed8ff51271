"""Quality rules: base counts and cross-document line frequency per host.

Every line is normalised (A-Z lower-cased, words joined by one space) and
hashed. Per host, the documents that hold a line are counted; a line in more
than ``limit_percent`` of its host's documents and in at least ``min_docs`` is
boilerplate and is removed. A document that keeps less than ``left_percent``
of its words is depleted and rejected, as is one that fails the base rules.

Copies must not make each other look like boilerplate, so the documents of a
host that hold the same set of lines are one class, and classes are counted:
those that hold the line, and those of the host. Documents that differ in any
line are counted each.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sluice.llm._stage import arrow_map, staged
from sluice.llm._text import LINE_TABLE, Words, mix, range_hashes, text_slices, windows

MIN_WORDS = 20
REPEAT_WINDOW = 8
REPEAT_PERCENT = 30
LIMIT_PERCENT = 10
MIN_DOCS = 10
LEFT_PERCENT = 30
SLICE_BYTES = 1 << 18  # of texts that are counted at a time

_SYMBOL = np.zeros(256, bool)
_SYMBOL[list(b"#*$%&|<>")] = True
_COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


def _per_row(flags: np.ndarray, offs: np.ndarray) -> np.ndarray:
    """Number of set flags in each row's byte range."""
    return np.diff(np.searchsorted(np.flatnonzero(flags), offs))


def _repeated(keys: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Per key: occurs twice or more in its row; is an earlier one's repetition."""
    salted = mix(keys + rows.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    order = np.argsort(salted, kind="stable")
    same = np.diff(salted[order]) == 0
    again = np.zeros(len(keys), bool)
    again[order[1:]] = same
    twice = again.copy()
    twice[order[:-1]] |= same
    return twice, again


def base_counts(buf: np.ndarray, offs: np.ndarray) -> list[np.ndarray]:
    """The five base counts of every row of a slice."""
    n = len(offs) - 1
    w = Words(buf, offs)
    chars = _per_row(w.inside & ((buf & 0xC0) != 0x80), offs)
    symbols = _per_row(_SYMBOL[buf], offs)
    # Lines that hold a word and equal an earlier one of the text.
    line_ends = np.flatnonzero(buf == 10)
    line_starts = np.concatenate([[0], line_ends[:-1] + 1])
    has_word = np.diff(np.searchsorted(w.starts, np.concatenate([line_starts, [len(buf)]]))) > 0
    # An empty line's start is its own newline byte, so every hash range is non-empty.
    hashes = range_hashes(buf, line_starts, LINE_TABLE)
    rows = np.searchsorted(offs, line_starts, side="right") - 1
    _, again = _repeated(hashes[has_word], rows[has_word])
    dup = np.bincount(rows[has_word][again], minlength=n)
    # Words covered by windows that occur twice or more in the text.
    s, at = windows(w.hashes(), w.counts, REPEAT_WINDOW)
    doc = w.rows()
    if len(s):
        twice, _ = _repeated(s, doc[at])
        edge = np.zeros(len(doc) + REPEAT_WINDOW + 1, np.int64)
        edge[at[twice]] += 1
        edge[at[twice] + REPEAT_WINDOW] -= 1
        covered = np.cumsum(edge)[:len(doc)] > 0
        repeat = np.bincount(doc[covered], minlength=n)
    else:
        repeat = np.zeros(n, np.int64)
    return [w.counts, chars, symbols, dup, repeat]


def normalised_lines(text: bytes) -> list[tuple[int, int, int]]:
    """(hash, number of words, index in the text) of every line with a word."""
    out = []
    for i, line in enumerate(text.lower().split(b"\n")):
        words = line.split()
        if words:
            out.append((int.from_bytes(hashlib.md5(b" ".join(words), usedforsecurity=False).digest()[:8], "big"),
                        len(words), i))
    return out


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    lists = pa.list_(pa.struct([("line", pa.int64()), ("words", pa.int64()), ("at", pa.int32())]))
    schema = pa.schema([("doc_id", pa.int64()), ("h", pa.int64()), ("host", pa.string()), *[(c, pa.int64()) for c in _COUNTS],
                        ("lines", lists), ("class", pa.int64())])
    for b in batches:
        for lo, hi, buf, offs in text_slices(b.column("text"), SLICE_BYTES):
            lines, ends, classes = [], [0], []
            for r in range(hi - lo):
                ls = normalised_lines(buf[offs[r]:offs[r + 1]].tobytes())
                lines += ls
                ends.append(len(lines))
                alike = b"".join(h.to_bytes(8, "big") for h in sorted({h for h, _, _ in ls}))
                classes.append(int.from_bytes(hashlib.md5(alike, usedforsecurity=False).digest()[:8], "big", signed=True))
            flat = pa.StructArray.from_arrays(
                [pa.array([h - (1 << 63) for h, _, _ in lines], pa.int64()), pa.array([k for _, k, _ in lines], pa.int64()),
                 pa.array([i for _, _, i in lines], pa.int32())], fields=list(lists.value_type))
            yield pa.RecordBatch.from_arrays(
                [*[b.column(c).slice(lo, hi - lo) for c in ("doc_id", "h", "host")],
                 *[pa.array(c, pa.int64()) for c in base_counts(buf, offs)],
                 pa.ListArray.from_arrays(pa.array(ends, pa.int32()), flat).cast(lists), pa.array(classes, pa.int64())],
                schema=schema)


def quality(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", host_col: str = "source",
            limit_percent: int = LIMIT_PERCENT, min_docs: int = MIN_DOCS,
            left_percent: int = LEFT_PERCENT) -> DataFrame:
    """Counts and verdict, one row per row of ``docs``:
    doc_id, h (hash of the text), host, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
    n_removed_words, base_failed, kept, removed_lines (indexes among the
    ``\\n``-split lines).

    A null or empty text has no words and fails the base rules. Rows without
    a host form one host of their own. Rows that repeat an id are judged
    each by its own text. Other columns are ignored, so their names cannot
    clash; an empty table gives an empty result.
    """
    scanned = staged(arrow_map(
        docs.select(F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(F.col(text_col)).alias("h"),
                    F.coalesce(F.col(host_col).cast("string"), F.lit("\x00")).alias("host"), F.col(text_col).alias("text")), _scan,
        "doc_id long, h long, host string, " + ", ".join(f"{c} long" for c in _COUNTS)
        + ", lines array<struct<line:long,words:long,at:int>>, class long")
        .withColumn("row", F.monotonically_increasing_id()), "quality_scan")
    worded = scanned.filter("size(lines) > 0")
    held = worded.select("host", "class", F.explode("lines.line").alias("line")).distinct()
    counted = held.groupBy("host", "line").agg(F.count("*").alias("n"))
    sizes = worded.select("host", "class").distinct().groupBy("host").agg(F.count("*").alias("docs"))
    # Written, so that its size is known: the planner broadcasts a small table
    # of frequent lines, and joins a large one by (host, line), splitting skewed parts.
    frequent = staged(
        counted.filter(F.col("n") >= min_docs).join(sizes, "host")
        .filter(F.col("n") * 100 > F.col("docs") * limit_percent).select("host", "line"), "frequent")
    # Written for the same reason: rows without a frequent line are not moved to learn that.
    found = staged(worded.select("row", "host", F.explode("lines").alias("l")).select("row", "host", "l.*")
                   .join(frequent, ["host", "line"]).groupBy("row")
                   .agg(F.array_sort(F.collect_list("at")).alias("removed_lines"), F.sum("words").alias("lost")),
                   "found_lines")
    return (scanned.drop("lines", "class").join(found, "row", "left")
            .withColumn("removed_lines", F.coalesce("removed_lines", F.array().cast("array<int>")))
            .withColumn("n_removed_words", F.coalesce("lost", F.lit(0)).cast("long"))
            .withColumn("base_failed", (F.col("n_words") < MIN_WORDS)
                        | (100 * F.col("n_repeat_words") > REPEAT_PERCENT * F.col("n_words")))
            .withColumn("kept", ~F.col("base_failed")
                        & (100 * (F.col("n_words") - F.col("n_removed_words"))
                           >= left_percent * F.col("n_words")))
            .select("doc_id", "h", "host", *_COUNTS, "n_removed_words", "base_failed", "kept", "removed_lines"))


def apply_rules(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", host_col: str = "source",
                **limits: int) -> DataFrame:
    """``docs`` without the rejected rows; the frequent lines of the others are cut out of their texts."""
    verdicts = staged(quality(docs, id_col, text_col, host_col, **limits).filter("not kept or size(removed_lines) > 0")
                      .select("doc_id", "h", "host", "kept", "removed_lines").distinct(), "verdicts")
    d = docs.select(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(docs.columns)],
                    F.col(f"`{id_col}`").cast("long").alias("k_id"), F.xxhash64(F.col(f"`{text_col}`")).alias("k_h"),
                    F.coalesce(F.col(f"`{host_col}`").cast("string"), F.lit("\x00")).alias("k_host"))
    # The verdicts have no size bound: one plan at every size, no broadcast.
    joined = d.join(verdicts.hint("merge"), F.col("k_id").eqNullSafe(F.col("doc_id")) & (F.col("k_h") == F.col("h"))
                    & (F.col("k_host") == F.col("host")), "left").filter("kept is null or kept")
    at = docs.columns.index(text_col)
    cut = arrow_map(joined.select(*[f"c{i}" for i in range(len(docs.columns))], "removed_lines"), _cut(f"c{at}"),
                    ", ".join(f"c{i} {f.dataType.simpleString()}" for i, f in enumerate(docs.schema.fields)))
    return cut.select(*[F.col(f"c{i}").alias(c) for i, c in enumerate(docs.columns)])


def _cut(text: str):
    """Texts without their removed lines, in one pass."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            removed = b.column("removed_lines")
            k = b.schema.get_field_index(text)
            sizes = pc.fill_null(pc.list_value_length(removed), 0).to_numpy(zero_copy_only=False)
            if sizes.any():
                texts = b.column(text).to_pylist()
                for r in np.flatnonzero(sizes):
                    gone = set(removed[r].as_py())
                    texts[r] = "\n".join(x for i, x in enumerate(texts[r].split("\n")) if i not in gone)
                b = b.set_column(k, text, pa.array(texts, b.schema.field(k).type))
            yield b.drop_columns(["removed_lines"])
    return run


_PAT = r"[^\x20\x09-\x0D]+"
ORACLE = rf"""
WITH w AS (SELECT doc_id, coalesce(source, chr(0)) AS host, coalesce(text, '') AS text,
                  regexp_extract_all(coalesce(text, ''), '{_PAT}') AS ws FROM documents),
l0 AS (SELECT doc_id, host, unnest(string_split(text, chr(10))) AS l,
              generate_subscripts(string_split(text, chr(10)), 1) AS i FROM w),
l1 AS (SELECT doc_id, host, l, i, regexp_extract_all(
          translate(l, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{_PAT}') AS ws
       FROM l0 WHERE regexp_matches(l, '{_PAT}')),
ln AS (SELECT doc_id, host, i, left(md5(array_to_string(ws, ' ')), 16) AS h, len(ws) AS k,
              row_number() OVER (PARTITION BY doc_id, l ORDER BY i) AS seen FROM l1),
cls AS (SELECT doc_id, array_to_string(list_sort(list_distinct(list(h))), '') AS cls FROM ln GROUP BY doc_id),
held AS (SELECT DISTINCT host, h, cls FROM ln JOIN cls USING (doc_id)),
sizes AS (SELECT host, count(DISTINCT cls) AS docs FROM held GROUP BY host),
frequent AS (SELECT host, h FROM (SELECT host, h, count(*) AS n FROM held GROUP BY host, h) JOIN sizes USING (host)
             WHERE n >= {MIN_DOCS} AND n * 100 > docs * {LIMIT_PERCENT}),
per_line AS (SELECT doc_id, sum(CASE WHEN seen > 1 THEN 1 ELSE 0 END) AS dup,
                    sum(CASE WHEN f.h IS NOT NULL THEN k ELSE 0 END) AS lost
             FROM ln LEFT JOIN frequent f ON ln.host = f.host AND ln.h = f.h GROUP BY doc_id),
p AS (SELECT doc_id, ws, unnest(range(1, len(ws) - {REPEAT_WINDOW} + 2)) AS p FROM w WHERE len(ws) >= {REPEAT_WINDOW}),
s AS (SELECT doc_id, p, array_to_string(ws[p:p + {REPEAT_WINDOW} - 1], ' ') AS s FROM p),
t AS (SELECT doc_id, p, count(*) OVER (PARTITION BY doc_id, s) AS n FROM s),
c AS (SELECT doc_id, count(DISTINCT p + k) AS n FROM t, range(0, {REPEAT_WINDOW}) r(k) WHERE n > 1 GROUP BY doc_id),
b AS (SELECT w.doc_id, len(ws) AS n_words, length(array_to_string(ws, '')) AS word_chars,
             length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS n_symbols,
             coalesce(per_line.dup, 0) AS n_dup_lines, coalesce(c.n, 0) AS n_repeat_words,
             coalesce(per_line.lost, 0) AS n_removed_words
      FROM w LEFT JOIN per_line USING (doc_id) LEFT JOIN c USING (doc_id)),
v AS (SELECT *, n_words < {MIN_WORDS} OR 100 * n_repeat_words > {REPEAT_PERCENT} * n_words AS base_failed FROM b)
SELECT doc_id, n_words, word_chars::BIGINT AS word_chars, n_symbols, n_dup_lines::BIGINT AS n_dup_lines,
       n_repeat_words, n_removed_words::BIGINT AS n_removed_words, base_failed,
       NOT base_failed AND 100 * (n_words - n_removed_words) >= {LEFT_PERCENT} * n_words AS kept
FROM v
"""
