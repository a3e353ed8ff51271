"""Target-distribution importance resampling by bit-sliced aggregation.

Features are all runs of one and two words; a feature's bucket is the crc32
of its bytes modulo ``BUCKETS``. A bucket's gain is the rounded-down log ratio
of target to raw text, in thousandths. A document's sum of gains is computed
on bit planes: its bucket counts become planes of ``BUCKETS`` bits (plane i
holds bit i of every count); each is ANDed with the planes of the gains
(positive and negative magnitudes apart), and the set bits, weighted by powers
of two and the sign, add up to the exact sum.

The draw is the Gumbel top-k: keyed noise is added to the mean gain, and the
highest scores are taken in order, by a range-partitioned sort with positions.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sluice.llm._sql import CRC_TABLE_SQL, crc_sql
from sluice.llm._stage import arrow_map, staged
from sluice.llm._text import text_slices
from sluice.operators.topk import sorted_positions

BUCKETS = 10_000
MIN_WORDS = 20
SHARE_PERCENT = 25
SEED = 7
_WORDS64 = -(-BUCKETS // 64)
_SHORT = 48  # longer words are hashed one by one
_ROWS = 256  # documents whose planes are held at once

_INSIDE = np.zeros(256, bool)
_INSIDE[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 32


def _crc_table() -> np.ndarray:
    t = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        t = np.where(t & 1, np.uint32(0xEDB88320) ^ (t >> np.uint32(1)), t >> np.uint32(1))
    return t


_CRC = _crc_table()


def _after_zeros() -> np.ndarray:
    """[length][byte number][byte]: what a crc register's byte becomes after ``length`` zero bytes."""
    step = np.stack([np.arange(256, dtype=np.uint32) << np.uint32(8 * k) for k in range(4)])
    out = [step]
    for _ in range(_SHORT + 1):
        step = (step >> np.uint32(8)) ^ _CRC[step & np.uint32(255)]
        out.append(step)
    return np.stack(out)


_ZEROS = _after_zeros()


def joined_crc(a: np.ndarray, b: np.ndarray, b_len: np.ndarray) -> np.ndarray:
    """crc32 of a text and a following one of ``b_len`` bytes, from their own crcs."""
    moved = _ZEROS[b_len, 0, a & 255] ^ _ZEROS[b_len, 1, (a >> 8) & 255]
    return moved ^ _ZEROS[b_len, 2, (a >> 16) & 255] ^ _ZEROS[b_len, 3, a >> 24] ^ b


def _word_crcs(buf: np.ndarray, starts: np.ndarray, lens: np.ndarray) -> np.ndarray:
    """crc32 of every word; short ones byte by byte, all words at once."""
    order = np.argsort(-np.minimum(lens, _SHORT + 1), kind="stable")
    first, size = starts[order], lens[order]
    n_long = int(np.searchsorted(-size, -_SHORT, side="left"))
    crc = np.full(len(starts), np.uint32(0xFFFFFFFF))
    for i in range(int(size[n_long]) if n_long < len(size) else 0):
        live = int(np.searchsorted(-size, -i, side="left"))  # words longer than i
        c = crc[n_long:live]
        crc[n_long:live] = (c >> np.uint32(8)) ^ _CRC[(c ^ buf[first[n_long:live] + i]) & np.uint32(255)]
    crc ^= np.uint32(0xFFFFFFFF)
    for k in range(n_long):
        crc[k] = zlib.crc32(buf[first[k]:first[k] + size[k]])
    out = np.empty_like(crc)
    out[order] = crc
    return out


def feature_buckets(buf: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(words per row, row of every feature, bucket of every feature) of a slice of texts."""
    inside = _INSIDE[buf]
    step = np.diff(inside.view(np.int8), prepend=np.int8(0))
    starts, ends = np.flatnonzero(step == 1), np.flatnonzero(step == -1)
    counts = np.diff(np.searchsorted(starts, offs))
    rows = np.repeat(np.arange(len(counts)), counts)
    low = _LOWER[buf]
    lens = ends - starts
    crc = _word_crcs(low, starts, lens)
    at = np.flatnonzero(rows[1:] == rows[:-1])
    short = lens[at + 1] <= _SHORT
    pair = np.empty(len(at), np.uint32)
    s = at[short]
    spaced = joined_crc(crc[s], np.full(len(s), np.uint32(zlib.crc32(b" "))), np.ones(len(s), np.int64))
    pair[short] = joined_crc(spaced, crc[s + 1], lens[s + 1])
    for k in np.flatnonzero(~short):
        w = at[k] + 1
        pair[k] = zlib.crc32(low[starts[w]:ends[w]], zlib.crc32(b" ", int(crc[at[k]])))
    return counts, np.concatenate([rows, rows[at]]), np.concatenate([crc, pair]) % BUCKETS


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(target, bucket, features) per task and table."""
    seen = np.zeros((2, BUCKETS), np.int64)
    for b in batches:
        target = b.column("target").to_numpy(zero_copy_only=False).astype(np.int64)
        for lo, hi, buf, offs in text_slices(b.column("text")):
            _, rows, buckets = feature_buckets(buf, offs)
            seen += np.bincount(target[lo:hi][rows] * BUCKETS + buckets, minlength=2 * BUCKETS).reshape(2, BUCKETS)
    target, bucket = np.nonzero(seen)
    yield pa.RecordBatch.from_arrays([pa.array(target == 1), pa.array(bucket), pa.array(seen[target, bucket])],
                                     names=["target", "bucket", "n"])


def bucket_gains(raw: np.ndarray, target: np.ndarray) -> np.ndarray:
    """floor(1000 * ln(smoothed target share / smoothed raw share)) per bucket."""
    s, t = raw.astype(np.float64), target.astype(np.float64)
    ratio = ((t + 1) * (s.sum() + BUCKETS)) / ((s + 1) * (t.sum() + BUCKETS))
    return np.floor(1000 * np.log(ratio)).astype(np.int64)


def _packed(bits: np.ndarray) -> np.ndarray:
    """Rows of ``BUCKETS`` flags as rows of 64-bit words."""
    wide = np.zeros((*bits.shape[:-1], _WORDS64 * 64), bool)
    wide[..., :BUCKETS] = bits
    return np.packbits(wide, axis=-1).view(np.uint64)


def gain_planes(gains: np.ndarray) -> list[tuple[int, np.ndarray]]:
    """(signed power of two, plane): the bits of the positive and of the negative gains."""
    out = []
    for sign in (1, -1):
        size = np.maximum(sign * gains, 0)
        for j in range(int(size.max()).bit_length()):
            out.append((sign * (1 << j), _packed(((size >> j) & 1).astype(bool))))
    return out


def bit_sliced_sums(rows: np.ndarray, buckets: np.ndarray, n: int, planes: list[tuple[int, np.ndarray]]) -> np.ndarray:
    """Sum of the buckets' gains per row, from planes of counts and planes of gains."""
    sums = np.zeros(n, np.int64)
    keys, counts = np.unique(rows * BUCKETS + buckets, return_counts=True)
    row, bucket = keys // BUCKETS, keys % BUCKETS
    for lo in range(0, n, _ROWS):
        a, b = np.searchsorted(row, [lo, lo + _ROWS])
        if a == b:
            continue
        r, c, k = row[a:b] - lo, counts[a:b], bucket[a:b]
        for i in range(int(c.max()).bit_length()):
            on = (c >> i) & 1 == 1
            have, line = np.unique(r[on], return_inverse=True)  # rows with any bit in this plane
            bits = np.zeros((len(have), BUCKETS), bool)
            bits[line, k[on]] = True
            count_plane = _packed(bits)
            part = np.zeros(len(have), np.int64)
            for power, plane in planes:
                part += power * np.bitwise_count(count_plane & plane).sum(axis=1, dtype=np.int64)
            sums[lo + have] += part << i
    return sums


def gumbel(doc_ids: list, seed: int) -> np.ndarray:
    """floor(-1000 * ln(-ln(u))) with u from the first 32 bits of sha256(``<seed>:<doc_id>``)."""
    h = [int(hashlib.sha256(f"{seed}:{'' if d is None else d}".encode()).hexdigest()[:8], 16) for d in doc_ids]
    u = (np.array(h, np.float64) + 0.5) / 4294967296
    return np.floor(-1000 * np.log(-np.log(u))).astype(np.int64)


def _score(gains: np.ndarray, seed: int):
    schema = pa.schema([(c, pa.int64()) for c in ("doc_id", "n_words", "n_features", "weight", "score")])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        planes = gain_planes(gains)
        for b in batches:
            ids = b.column("doc_id")
            for lo, hi, buf, offs in text_slices(b.column("text")):
                words, rows, buckets = feature_buckets(buf, offs)
                n = np.bincount(rows, minlength=hi - lo)
                weight = bit_sliced_sums(rows, buckets, hi - lo, planes) // np.maximum(n, 1)
                some = ids.slice(lo, hi - lo)
                score = weight + gumbel(some.to_pylist(), seed)
                yield pa.RecordBatch.from_arrays(
                    [some, *[pa.array(x, pa.int64()) for x in (words, n, weight, score)]], schema=schema)
    return run


def importance_draw(docs: DataFrame, target: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    target_text_col: str = "text", share_percent: int = SHARE_PERCENT,
                    min_words: int = MIN_WORDS, seed: int = SEED) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_features, weight, score, rank (null if not drawn).

    weight is the floored mean gain over the document's features (0 without
    any), score adds the keyed noise. Of the N rows with at least
    ``min_words`` words, floor(``share_percent`` * N / 100) are drawn: the
    highest scores, ties to the smaller id (a null id last). Null and empty
    texts, in both tables, have no features. A null id is written as empty text in the
    noise key; rows that repeat an id have the same noise and stand apart in
    the ranking, in no particular order if their scores are equal. Other
    columns are ignored; an empty table gives an empty result, an empty
    target table gains from smoothing alone.
    """
    docs = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{text_col}`").alias("text"))
    both = docs.select(F.lit(False).alias("target"), "text").union(
        target.select(F.lit(True), F.col(f"`{target_text_col}`")))
    # At most two rows per bucket come to the driver.
    seen = np.zeros((2, BUCKETS), np.int64)
    for r in (arrow_map(both, _count, "target boolean, bucket long, n long").groupBy("target", "bucket")
              .agg(F.sum("n").alias("n")).collect()):
        seen[int(r["target"]), r["bucket"]] = r["n"]
    scored = staged(arrow_map(docs, _score(bucket_gains(seen[0], seen[1]), seed),
                              "doc_id long, n_words long, n_features long, weight long, score long"), "scored")
    able = F.col("n_words") >= min_words
    drawn = scored.filter(able).count() * share_percent // 100
    ranked = sorted_positions(scored, [able.desc(), F.col("score").desc(), F.col("doc_id").asc_nulls_last()], "rank")
    return ranked.select("doc_id", "n_features", "weight", "score",
                         F.when(F.col("rank") <= F.lit(drawn), F.col("rank")).alias("rank"))


_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_PAT = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def _features_sql(table: str, id_col: str) -> str:
    words = f"regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_UPPER.lower()}'), '{_PAT}')"
    return (f"SELECT {id_col} AS id, len(ws) AS n_words, unnest(list_concat(ws, list_transform(range(1, len(ws)), "
            f"lambda i: ws[i] || ' ' || ws[i + 1]))) AS f FROM (SELECT {id_col}, {words} AS ws FROM {table})")


ORACLE = f"""
WITH {CRC_TABLE_SQL.strip()},
d AS ({_features_sql("documents", "doc_id")}),
q AS ({_features_sql("benchmark", "item_id")}),
hashed AS (SELECT f, {crc_sql("f")} % {BUCKETS} AS bucket FROM (SELECT f FROM d UNION SELECT f FROM q), tab),
s AS (SELECT bucket, count(*) AS s FROM d JOIN hashed USING (f) GROUP BY bucket),
t AS (SELECT bucket, count(*) AS t FROM q JOIN hashed USING (f) GROUP BY bucket),
gain AS (SELECT b.bucket, floor(1000 * ln(
    ((coalesce(t, 0) + 1)::DOUBLE * ((SELECT coalesce(sum(s), 0) FROM s) + {BUCKETS})::DOUBLE)
    / ((coalesce(s, 0) + 1)::DOUBLE * ((SELECT coalesce(sum(t), 0) FROM t) + {BUCKETS})::DOUBLE)))::BIGINT AS gain
  FROM range({BUCKETS}) b(bucket) LEFT JOIN s USING (bucket) LEFT JOIN t USING (bucket)),
summed AS (SELECT d.id AS doc_id, any_value(n_words) AS n_words, count(*) AS n_features,
    floor(sum(gain)::DOUBLE / count(*))::BIGINT AS weight
  FROM d JOIN hashed USING (f) JOIN gain USING (bucket) GROUP BY d.id),
scored AS (SELECT doc_id, coalesce(n_words, 0) AS n_words, coalesce(n_features, 0) AS n_features,
    coalesce(weight, 0) AS weight, coalesce(weight, 0) + floor(-1000 * ln(-ln(
      (('0x' || substr(sha256('{SEED}:' || doc_id), 1, 8))::BIGINT + 0.5::DOUBLE) / 4294967296)))::BIGINT AS score
  FROM documents LEFT JOIN summed USING (doc_id)),
ranked AS (SELECT *, row_number() OVER (ORDER BY n_words >= {MIN_WORDS} DESC, score DESC, doc_id) AS place,
    count(*) FILTER (WHERE n_words >= {MIN_WORDS}) OVER () AS able FROM scored)
SELECT doc_id, n_features, weight, score, CASE WHEN place <= {SHARE_PERCENT} * able // 100 THEN place END AS rank
FROM ranked
"""
