"""Importance resampling: hashed n-gram models of target and raw text, Gumbel top-k.

Words and word pairs (A-Z lower-cased) are hashed into ``BUCKETS`` buckets.
The raw model counts all documents; the target model counts labelled documents
of good quality that are not toxic, smoothed towards the raw model by
``PRIOR`` n-grams. A document's log weight is the sum of log(p_target / p_raw)
over its n-grams; adding keyed Gumbel noise and keeping the ``k`` largest keys
draws ``k`` documents without replacement, in proportion to their weights.

``k`` is the share of good rows among the labelled ones, times all rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sluice.llm._stage import arrow_map, staged
from sluice.llm._text import LOWER_TABLE, Words, mix, text_slices

BUCKETS = 10_000
TARGET_ROWS = 20_000  # the target model is fitted on at most so many labelled rows
PRIOR = 10_000
SEED = 20240229


def ngram_buckets(buf: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(row, bucket) of every word and every pair of neighbouring words."""
    w = Words(buf, offs)
    h = w.hashes(LOWER_TABLE)
    rows = w.rows()
    pair = np.flatnonzero(rows[1:] == rows[:-1])
    pairs = mix(h[pair] * np.uint64(0x9FB21C651E98DF25) + h[pair + 1])
    b = np.uint64(BUCKETS)
    return np.concatenate([rows, rows[pair]]), np.concatenate([h % b, pairs % b]).astype(np.int64)


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    raw, target = np.zeros(BUCKETS, np.int64), np.zeros(BUCKETS, np.int64)
    for b in batches:
        is_target = b.column("is_target").to_numpy(zero_copy_only=False).astype(bool)
        for lo, hi, buf, offs in text_slices(b.column("text")):
            rows, buckets = ngram_buckets(buf, offs)
            raw += np.bincount(buckets, minlength=BUCKETS)
            target += np.bincount(buckets[is_target[lo:hi][rows]], minlength=BUCKETS)
    yield pa.RecordBatch.from_arrays([pa.array(np.arange(BUCKETS)), pa.array(raw), pa.array(target)],
                                     names=["bucket", "raw", "target"])


def log_ratios(raw: np.ndarray, target: np.ndarray) -> np.ndarray:
    """log(p_target / p_raw) per bucket; 0 where the raw text has none."""
    p_raw = raw / max(1, raw.sum())
    p_target = (target + PRIOR * p_raw) / (target.sum() + PRIOR)
    seen = raw > 0
    return np.log(np.where(seen, p_target, 1) / np.where(seen, p_raw, 1))


def gumbel(keys: np.ndarray, seed: int) -> np.ndarray:
    """Standard Gumbel noise from 64-bit keys."""
    u = (mix(keys ^ np.uint64(seed)) >> np.uint64(11)).astype(np.float64)
    return -np.log(-np.log((u + 0.5) / 2.0 ** 53))


def _score(ratios: np.ndarray, seed: int):
    schema = pa.schema([("doc_id", pa.int64()), ("h", pa.int64()), ("n_grams", pa.int64()),
                        ("log_weight", pa.float64()), ("noisy", pa.float64()), ("rank_key", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for lo, hi, buf, offs in text_slices(b.column("text")):
                rows, buckets = ngram_buckets(buf, offs)
                n = np.bincount(rows, minlength=hi - lo)
                weight = np.bincount(rows, weights=ratios[buckets], minlength=hi - lo)
                ids, h = b.column("doc_id").slice(lo, hi - lo), b.column("h").slice(lo, hi - lo)
                key = mix(ids.fill_null(0).to_numpy().view(np.uint64)) ^ h.to_numpy().view(np.uint64)
                noisy = weight + gumbel(key, seed) + 0.0
                bits = noisy.view(np.int64)
                order = np.where(bits < 0, bits ^ np.int64(0x7FFFFFFFFFFFFFFF), bits)  # same order as the doubles
                yield pa.RecordBatch.from_arrays(
                    [ids, h, pa.array(n, pa.int64()), pa.array(weight), pa.array(noisy), pa.array(order)],
                    schema=schema)
    return run


def kth_largest(df: DataFrame, col: str, k: int) -> int | None:
    """The ``k``-th largest value of a long column (None if there are fewer rows),
    16 bits at a time: each step groups what is left by one digit, so at most
    65,536 counts reach the driver."""
    if k <= 0:
        return None
    prefix, left = None, k
    for shift in (48, 32, 16, 0):
        part = df if prefix is None else df.filter(F.shiftright(col, shift + 16) == F.lit(prefix))
        rows = part.groupBy(F.shiftright(col, shift).alias("d")).count().collect()
        for r in sorted(rows, key=lambda r: -r[0]):
            if left <= r[1]:
                prefix = r[0]
                break
            left -= r[1]
        else:
            return None
    return prefix


def resample(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
             share: float | None = None, target_rows: int = TARGET_ROWS, seed: int = SEED) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_grams, log_weight, noisy (log weight
    plus Gumbel noise) and kept (among the k largest ``noisy``; rows tied with
    the last one are kept too). ``share`` sets k as a share of all rows; by
    default it is the share of labelled rows with quality 1.

    ``labels`` has doc_id, quality, toxic. The target model is fitted on the
    ``target_rows`` labelled rows with the smallest id hash; everything else
    covers all rows. A null or empty text has no n-grams and weight 0. Rows
    without an id take part; rows that repeat id and text get the same noise.
    Without any target row all ratios are 0 and the sample is uniform. Other
    columns are ignored. An empty table gives an empty result.
    """
    docs = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"),
                       F.xxhash64(F.col(text_col)).alias("h"))
    good = labels.filter("quality is not null and doc_id is not null").agg(
        F.count("*").alias("n"), F.count_if(F.col("quality") == 1).alias("good")).first()
    target = staged(labels.filter("quality = 1 and coalesce(toxic, 0) = 0 and doc_id is not null")
                    .select("doc_id").distinct().orderBy(F.xxhash64("doc_id", F.lit(seed)), "doc_id")
                    .limit(target_rows), "target")
    # The target ids are bounded by target_rows, hence the broadcast.
    flagged = (docs.join(F.broadcast(target.withColumn("is_target", F.lit(True))), "doc_id", "left")
               .select(F.coalesce("is_target", F.lit(False)).alias("is_target"), "text"))
    counts = (arrow_map(flagged, _count, "bucket long, raw long, target long").groupBy("bucket")
              .agg(F.sum("raw").alias("raw"), F.sum("target").alias("target")).collect())  # one row per bucket
    raw, hit = np.zeros(BUCKETS, np.int64), np.zeros(BUCKETS, np.int64)
    for r in counts:
        raw[r["bucket"]], hit[r["bucket"]] = r["raw"], r["target"]
    ratios = log_ratios(raw, hit) if hit.sum() else np.zeros(BUCKETS)
    scored = staged(arrow_map(docs, _score(ratios, seed), "doc_id long, h long, n_grams long, log_weight double, "
                              "noisy double, rank_key long"), "scored")
    if share is None:
        share = good["good"] / good["n"] if good["n"] else 1.0
    least = kth_largest(scored, "rank_key", round(share * scored.count()))
    kept = F.lit(False) if least is None else F.col("rank_key") >= F.lit(least)
    return scored.select("doc_id", "n_grams", "log_weight", "noisy", kept.alias("kept"))
