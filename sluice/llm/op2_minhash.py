"""MinHash near-duplicates with sequential Bayesian verification.

Distinct shingle sets are signed with ``VALUES`` MinHash values, the first
``BANDS * ROWS`` of which form bands. Equal bands propose pairs; a pair's signatures are then compared batch by batch and
it is dropped as soon as the posterior probability that its similarity
reaches the threshold falls below ``miss`` (uniform prior: after m matches in
n hashes, P(p >= t) = P(Binomial(n + 1, t) <= m)). Survivors are verified
exactly on the full sets. Compared are the values' low bytes; unequal values
agree there once in 256, which raises t to t + (1 - t) / 256.

A bucket never emits all its pairs. Every document is compared with the
bucket's hub, the member that shares the most buckets with the others (the
centre of a group of copies, as its values are the modal ones). Only members
that the links found so far leave in different components are compared with
each other afterwards, inside tasks: a bucket is cut into blocks of at most
``BLOCK`` members, each pair of blocks is one bounded unit of work, and only
the pairs that survive all batches leave it.

Chance that a pair at the threshold shares no band: (1 - 0.75**5)**40 < 2e-5.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sluice.llm._components import components
from sluice.llm._stage import arrow_map, staged
from sluice.llm._text import LOWER_TABLE, Words, mix, sequence_hash, shingle_rows, signed, sorted_groups, text_slices, windows

SHINGLE = 5
BANDS, ROWS = 40, 5
VALUES = 400
PERCENT = 75  # similarity threshold, in hundredths
BATCH = 40  # signature values compared between two prunings
MISS = 1e-4
BLOCK = 1024
PAIRS_AT_ONCE = 1 << 15

_rng = np.random.Generator(np.random.PCG64(7))
_MUL = _rng.integers(0, 1 << 31, VALUES, dtype=np.uint32) * np.uint32(2) + np.uint32(1)
_XOR = _rng.integers(0, 1 << 32, VALUES, dtype=np.uint32)


def signatures(shingles: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """MinHash values (uint32), a row for each run of shingle hashes."""
    low = (shingles >> np.uint64(32)).astype(np.uint32)
    out = np.empty((len(_MUL), len(starts)), np.uint32)
    for j in range(len(_MUL)):
        out[j] = np.minimum.reduceat((low ^ _XOR[j]) * _MUL[j], starts)
    return np.ascontiguousarray(out.T)


def band_keys(sig: np.ndarray) -> np.ndarray:
    """64-bit keys, one per row and band; the band's number is part of the key."""
    h = np.tile(np.arange(1, BANDS + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15), (len(sig), 1))
    parts = sig[:, :BANDS * ROWS].reshape(len(sig), BANDS, ROWS).astype(np.uint64)
    for r in range(ROWS):
        h = mix(h + parts[:, :, r])
    return h


def _sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([("doc_id", pa.int64()), ("h", pa.int64()), ("n_shingles", pa.int64()), ("d1", pa.int64()),
                        ("d2", pa.int64()), ("sig", pa.binary()), ("bands", pa.binary())])
    for b in batches:
        for lo, hi, buf, offs in text_slices(b.column("text")):
            w = Words(buf, offs)
            h = w.hashes(LOWER_TABLE)
            s, at = windows(h, w.counts, SHINGLE)
            cut = np.searchsorted(at, w.bounds)
            sets = []
            for r in range(hi - lo):
                if w.counts[r] >= SHINGLE:
                    sets.append(np.unique(s[cut[r]:cut[r + 1]]))
                elif w.counts[r]:
                    sets.append(np.array([sequence_hash(h[w.bounds[r]:w.bounds[r + 1]])]))
                else:
                    sets.append(np.zeros(0, np.uint64))
            n = np.array([len(x) for x in sets])
            full = np.flatnonzero(n)
            d1, d2, sig, bands = ([None] * len(sets) for _ in range(4))
            if len(full):
                flat = np.concatenate([sets[r] for r in full])
                starts = np.cumsum(n[full]) - n[full]
                values = signatures(flat, starts)
                sums = np.add.reduceat(flat, starts), np.add.reduceat(mix(flat), starts)
                keys = band_keys(values)
                for k, r in enumerate(full):
                    d1[r], d2[r] = int(signed(sums[0])[k]), int(signed(sums[1])[k])
                    sig[r] = values[k].astype(np.uint8).tobytes()
                    bands[r] = keys[k].tobytes()
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id").slice(lo, hi - lo), b.column("h").slice(lo, hi - lo), pa.array(n, pa.int64()),
                 pa.array(d1, pa.int64()), pa.array(d2, pa.int64()), pa.array(sig, pa.binary()),
                 pa.array(bands, pa.binary())], schema=schema)


def _bands(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([("key", pa.int64()), ("node", pa.int64()), ("size", pa.int64())])
    for b in batches:
        if b.num_rows:
            keys = np.frombuffer(b"".join(b.column("bands").to_pylist()), np.int64)
            yield pa.RecordBatch.from_arrays(
                [pa.array(keys), pa.array(np.repeat(b.column("node").to_numpy(), BANDS)),
                 pa.array(np.repeat(b.column("size").to_numpy(), BANDS))], schema=schema)


@cache
def least_matches(n: int, threshold: float, miss: float) -> int:
    """Fewest matches among ``n`` hashes with which a pair may still reach the threshold."""
    t = threshold + (1 - threshold) / 256
    total = 0.0
    for m in range(n + 1):
        total += comb(n + 1, m) * t ** m * (1 - t) ** (n + 1 - m)
        if total >= miss:
            return m
    return n


def surviving(a: np.ndarray, b: np.ndarray, threshold: float, miss: float) -> np.ndarray:
    """Which rows of two signature matrices survive all batches of comparisons."""
    alive = np.arange(len(a))
    matches = np.zeros(len(a), np.int64)
    for lo in range(0, a.shape[1], BATCH):
        hi = min(lo + BATCH, a.shape[1])
        matches = matches + (a[alive, lo:hi] == b[alive, lo:hi]).sum(axis=1)
        ok = matches >= least_matches(hi, threshold, miss)
        alive, matches = alive[ok], matches[ok]
    return alive


def _matrix(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint8).reshape(len(column), -1)


def _across(percent: int, miss: float):
    """Pairs of a bucket's two blocks that lie in different components and survive."""
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for g in sorted_groups(batches, ["key", "i", "j"]):
            node, size, c, own = (g.column(k).to_numpy() for k in ("node", "size", "c", "own"))
            sig, bands = _matrix(g.column("sig")), _matrix(g.column("bands")).view(np.int64)
            key = g.column("key")[0].as_py()
            same = g.column("i")[0].as_py() == g.column("j")[0].as_py()
            left = np.arange(len(node)) if same else np.flatnonzero(own == g.column("i")[0].as_py())
            right = left if same else np.flatnonzero(own == g.column("j")[0].as_py())
            step = max(1, PAIRS_AT_ONCE // max(1, len(right)))
            for lo in range(0, len(left), step):
                x = left[lo:lo + step]
                fit = (c[x][:, None] != c[right]) & (
                    100 * np.minimum.outer(size[x], size[right]) >= percent * np.maximum.outer(size[x], size[right]))
                if same:
                    fit &= x[:, None] < right
                p, q = np.nonzero(fit)
                if len(p):
                    p, q = x[p], right[q]
                    ok = surviving(sig[p], sig[q], percent / 100, miss)
                    p, q = p[ok], q[ok]
                    # Of the buckets that two members share, only the first one's unit returns the pair.
                    shared = bands[p] == bands[q]
                    ok = bands[p, shared.argmax(axis=1)] == key
                    p, q = node[p[ok]], node[q[ok]]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.minimum(p, q)), pa.array(np.maximum(p, q))], schema=schema)
    return run


def _prune(percent: int, miss: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                ok = surviving(_matrix(b.column("sig_a")), _matrix(b.column("sig_b")), percent / 100, miss)
                yield b.select(["a", "b"]).take(pa.array(ok))
    return run


def _verify(percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            keep = []
            pairs = zip(shingle_rows(b.column("text_a"), SHINGLE), shingle_rows(b.column("text_b"), SHINGLE),
                        strict=True)
            for (i, x), (_, y) in pairs:
                both = len(np.intersect1d(x, y, assume_unique=True))
                if both and 100 * both >= percent * (len(x) + len(y) - both):
                    keep.append(i)
            yield b.select(["a", "b"]).take(pa.array(keep, pa.int64()))
    return run


def _surviving_pairs(pairs: DataFrame, sigs: DataFrame, percent: int, miss: float) -> DataFrame:
    return arrow_map(
        pairs.join(sigs.select(F.col("node").alias("a"), F.col("sig").alias("sig_a")), "a")
        .join(sigs.select(F.col("node").alias("b"), F.col("sig").alias("sig_b")), "b"),
        _prune(percent, miss), "a long, b long")


def _verified(near: DataFrame, texts: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose full sets reach the threshold."""
    near = staged(near, "near")
    return staged(arrow_map(
        near.join(texts.select(F.col("node").alias("a"), F.col("text").alias("text_a")), "a")
        .join(texts.select(F.col("node").alias("b"), F.col("text").alias("text_b")), "b"),
        _verify(percent), "a long, b long"), "links")


def duplicate_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                     percent: int = PERCENT, miss: float = MISS) -> DataFrame:
    """(doc_id, h, n_shingles, group, component_id) for every row of ``docs``: its
    text's hash, its group of near duplicates (a number of this run) and the
    group's smallest id.

    Rows are linked when 100 * |A and B| >= percent * |A or B| of their 5-word
    shingle sets (A-Z lower-cased). Every row is linked by its own text, also
    one that repeats an id. A text that is null or has no word has no shingles,
    a null group and itself as component; so has a row without an id, with a
    null component. Other columns are ignored, so their names cannot clash. An
    empty table gives an empty result.
    """
    docs = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.xxhash64(F.col(f"`{text_col}`")).alias("h"),
                       F.col(f"`{text_col}`").alias("text"))
    base = staged(arrow_map(docs, _sign, "doc_id long, h long, n_shingles long, d1 long, d2 long, sig binary, bands binary"),
                  "signed")
    # Equal sets are one node, shown by the row with the smallest id.
    sets = staged(base.filter("d1 is not null and doc_id is not null").groupBy("n_shingles", "d1", "d2")
                  .agg(F.min(F.struct("doc_id", "h")).alias("shown"), F.first("sig").alias("sig"),
                       F.first("bands").alias("bands")).withColumn("node", F.monotonically_increasing_id()), "sets")
    sigs = sets.select("node", "sig")
    bands = arrow_map(sets.select("node", F.col("n_shingles").alias("size"), "bands"), _bands,
                      "key long, node long, size long")
    shared = staged(bands.groupBy("key").agg(F.count("*").alias("n")).filter("n > 1"), "shared")
    rows = staged(bands.join(shared, "key"), "rows")  # only buckets that hold a pair
    # The only shuffle of texts: of rows that share a bucket with another set, one
    # per set. Neither side has a size bound: one plan at every size, no broadcast.
    needed = (rows.select("node").distinct().join(sets.select("node", "shown.*"), "node").hint("shuffle_hash"))
    texts = staged(docs.join(needed, ["doc_id", "h"]).dropDuplicates(["doc_id", "h"]).select("node", "text"), "texts")
    popular = rows.groupBy("node").agg(F.sum("n").alias("pop"))
    hubs = staged(rows.join(popular, "node").groupBy("key").agg(
        F.max(F.struct("pop", (-F.col("node")).alias("minus"), "size")).alias("hub"))
        .select("key", (-F.col("hub.minus")).alias("hub"), F.col("hub.size").alias("hub_size")), "hubs")
    first = staged(
        rows.join(hubs, "key").filter("node != hub")
        .filter(f"100 * least(size, hub_size) >= {int(percent)} * greatest(size, hub_size)")
        .select(F.least("node", "hub").alias("a"), F.greatest("node", "hub").alias("b")).distinct(), "first")
    links = _verified(_surviving_pairs(first, sigs, percent, miss), texts, percent)
    # Buckets whose members are still in different components: compare those.
    placed = staged(rows.join(components(links), "node", "left").select(
        "key", "node", "size", F.coalesce("component", "node").alias("c")), "placed")
    mixed = staged(placed.groupBy("key").agg(F.min("c").alias("lo"), F.max("c").alias("hi"), F.count("*").alias("n"))
                   .filter("lo != hi").select("key", F.ceil(F.col("n") / BLOCK).cast("int").alias("blocks")), "mixed")
    own = F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    units = (placed.join(mixed, "key").join(sets.select("node", "sig", "bands"), "node").withColumn("own", own).withColumn("other", other)
             .select("key", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"),
                     "own", "node", "size", "c", "sig", "bands"))
    units = units.repartition("key", "i", "j").sortWithinPartitions("key", "i", "j")
    rest = (arrow_map(units, _across(percent, miss), "a long, b long").distinct()
            .join(first, ["a", "b"], "left_anti"))
    links = links.union(_verified(rest, texts, percent))
    # Classes of equal sets, then components of their nodes and their smallest id.
    grouped = staged(sets.select("n_shingles", "d1", "d2", "node", F.col("shown.doc_id").alias("least"))
                     .join(components(links), "node", "left")
                     .select("n_shingles", "d1", "d2", "least", F.coalesce("component", "node").alias("group")), "grouped")
    smallest = grouped.groupBy("group").agg(F.min("least").alias("smallest"))
    classes = grouped.drop("least").join(smallest, "group")
    return (base.select("doc_id", "h", "n_shingles", "d1", "d2")
            .join(classes, ["n_shingles", "d1", "d2"], "left")
            .select("doc_id", "h", "n_shingles", F.when(F.col("doc_id").isNotNull(), F.col("group")).alias("group"),
                    F.when(F.col("doc_id").isNotNull(), F.coalesce("smallest", "doc_id")).alias("component_id")))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    percent: int = PERCENT, miss: float = MISS) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) for every row of ``docs``.

    ``component_id`` is the smallest id reachable over the links of
    ``duplicate_groups`` and ``kept`` says that the row has that id. A row
    without an id keeps null as its component and is kept.
    """
    return (duplicate_groups(docs, id_col, text_col, percent, miss)
            .select("doc_id", "n_shingles", "component_id")
            .withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True))))


def one_of_each_group(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                      percent: int = PERCENT, miss: float = MISS) -> DataFrame:
    """``docs`` with one row of each group of near duplicates: that of the smallest
    id, then of the smallest text hash; of rows equal in both, the first by the
    other columns. Rows without an id, or whose text has no word, all stay.
    """
    groups = duplicate_groups(docs, id_col, text_col, percent, miss).filter("group is not null").select("doc_id", "h", "group")
    best = groups.groupBy("group").agg(F.min(F.struct("doc_id", "h")).alias("best"), F.count(F.lit(1)).alias("n"))
    best = staged(best.filter("n > 1").select("group", F.col("best.doc_id").alias("b_id"), F.col("best.h").alias("b_h")), "best")
    places = groups.join(best, "group").groupBy("doc_id", "h", "b_id", "b_h").agg(F.count(F.lit(1)).alias("n"))
    is_best = (F.col("doc_id") == F.col("b_id")) & (F.col("h") == F.col("b_h"))
    # Written, so that the planner knows its size and moves no text where it is small.
    places = staged(places.filter(~is_best | (F.col("n") > 1)).select(
        F.col("doc_id").alias("p_id"), F.col("h").alias("p_h"), is_best.alias("p_best")), "places")
    here = ((F.col(f"`{id_col}`").cast("long") == F.col("p_id")) & (F.xxhash64(F.col(f"`{text_col}`")) == F.col("p_h")))
    columns = [F.col(f"`{c}`") for c in docs.columns]
    clear = docs.join(places, here, "left_anti").select(*columns)
    twins = docs.join(places.filter("p_best"), here)
    rest = [c for f, c in zip(docs.schema.fields, columns, strict=True) if f.name != text_col and f.dataType.typeName() != "map"]
    first = F.row_number().over(Window.partitionBy("p_id", "p_h").orderBy(*rest))
    return clear.unionByName(twins.withColumn("p_place", first).filter("p_place = 1").select(*columns))
