"""Conflict-constrained best-fit packing.

Documents are cut into pieces of at most ``capacity`` words. A full piece is a
bin of its own; the last, shorter piece of each document is packed: largest
first, each into the tightest open bin that holds no piece of the same source
and none of the same duplicate cluster, or into a new bin. Every bin carries a
bitmap of its sources and clusters. Bins are ordered by the room they have
left; the search starts at the piece's size and goes on to the next larger
room until a bin is compatible. A tree over the room sizes keeps, for each
range, the bits that all its bins have in common, so whole ranges are passed
over at once.

Packing runs on shards of about ``shard_docs`` documents, dealt by a hash of the
id, each packed in one task from sizes and keys alone (no texts).
"""

from __future__ import annotations

import heapq
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sluice.llm._stage import arrow_map
from sluice.llm._text import LOWER_TABLE, Words, mix, sorted_groups, text_slices

CAPACITY = 1024
SHARD_DOCS = 2048


class Bins:
    """Open bins by the room they have left."""

    def __init__(self, capacity: int):
        self.n = 1 << (capacity + 1).bit_length()
        self.common = [-1] * (2 * self.n)  # an empty range has all bits: nothing in it fits
        self.at: list[dict[int, list[int]]] = [{} for _ in range(capacity + 1)]

    def _refresh(self, room: int) -> None:
        bits = -1
        for mask in self.at[room]:
            bits &= mask
        k = room + self.n
        self.common[k] = bits
        while k > 1:
            k >>= 1
            self.common[k] = self.common[2 * k] & self.common[2 * k + 1]

    def put(self, room: int, mask: int, number: int) -> None:
        heapq.heappush(self.at[room].setdefault(mask, []), number)
        self._refresh(room)

    def _next(self, room: int, bits: int) -> int:
        """The smallest room >= ``room`` whose bins do not all hold one of the bits, or -1."""
        k = room + self.n
        while True:
            if not self.common[k] & bits:
                while k < self.n:
                    k *= 2
                    if self.common[k] & bits:
                        k += 1
                return k - self.n
            while k & 1:
                k >>= 1
            if not k:
                return -1
            k += 1
            if k & (k - 1) == 0:
                return -1

    def take(self, size: int, bits: int) -> tuple[int, int, int] | None:
        """Removes and returns (room, mask, number) of the tightest compatible bin;
        among equally tight ones the oldest."""
        room = self._next(size, bits)
        while room >= 0:
            fits = [(numbers[0], mask) for mask, numbers in self.at[room].items() if not mask & bits]
            if fits:
                number, mask = min(fits)
                heapq.heappop(self.at[room][mask])
                if not self.at[room][mask]:
                    del self.at[room][mask]
                self._refresh(room)
                return room, mask, number
            room = self._next(room + 1, bits) if room + 1 < len(self.at) else -1
        return None


def best_fit(sizes: list[int], sources: list, clusters: list, capacity: int) -> tuple[list[int], int]:
    """(bin of every piece, number of bins) for pieces in the given order."""
    bit: dict = {}
    shared = Counter(clusters)
    bins = Bins(capacity)
    out, count = [], 0
    for size, source, cluster in zip(sizes, sources, clusters, strict=True):
        bits = 1 << bit.setdefault(("source", source), len(bit))
        if shared[cluster] > 1:  # a cluster with one piece here conflicts with nothing
            bits |= 1 << bit.setdefault(("cluster", cluster), len(bit))
        found = bins.take(size, bits)
        if found is None:
            room, mask, number = capacity, 0, count
            count += 1
        else:
            room, mask, number = found
        out.append(number)
        if room > size:
            bins.put(room - size, mask | bits, number)
    return out, count


def _measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Words of a text, and a hash of its word sequence (A-Z lower-cased)."""
    for b in batches:
        for lo, hi, buf, offs in text_slices(b.column("text")):
            w = Words(buf, offs)
            h = w.hashes(LOWER_TABLE)
            place = np.arange(len(h), dtype=np.uint64) - np.repeat(w.bounds[:-1], w.counts).astype(np.uint64)
            total = np.concatenate([[np.uint64(0)], np.cumsum(mix(h + place * np.uint64(0x9E3779B97F4A7C15)))])
            cluster = mix(total[w.bounds[1:]] - total[w.bounds[:-1]] + w.counts.astype(np.uint64))
            part = b.slice(lo, hi - lo)
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), part.column("h"), part.column("source"),
                 pa.array(w.counts, pa.int64()), pa.array(cluster.view(np.int64))],
                names=["doc_id", "h", "source", "n_words", "cluster"])


def _pack(capacity: int):
    schema = pa.schema([("doc_id", pa.int64()), ("piece", pa.int64()), ("start_word", pa.int64()),
                        ("n_words", pa.int64()), ("bin_id", pa.int64()), ("source", pa.string()),
                        ("cluster", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for g in sorted_groups(batches, ["shard"]):
            rows = g.to_pylist()
            tails = [r for r in rows if r["tail"]]
            spot, n = best_fit([r["tail"] for r in tails], [r["source"] for r in tails],
                               [r["cluster"] for r in tails], capacity)
            base = rows[0]["shard"] << 32
            of = dict(zip(map(id, tails), spot, strict=True))
            out = []
            for r in rows:
                pieces = max(1, -(-r["n_words"] // capacity))
                for p in range(pieces):
                    size = min(capacity, r["n_words"] - p * capacity)
                    if size == capacity:
                        number, n = n, n + 1
                    else:
                        number = of.get(id(r)) if size else None
                    out.append({"doc_id": r["doc_id"], "piece": p, "start_word": p * capacity, "n_words": size,
                                "bin_id": None if number is None else base + number,
                                "source": r["source"], "cluster": r["cluster"]})
            yield pa.RecordBatch.from_pylist(out, schema=schema)
    return run


def pack(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
         cluster_col: str | None = None, capacity: int = CAPACITY, shard_docs: int = SHARD_DOCS) -> DataFrame:
    """One row per piece: doc_id, piece, start_word, n_words, bin_id, source, cluster.

    The cluster is ``cluster_col`` if given, else a hash of the lower-cased
    word sequence, so that exact copies never share a bin. A null source or
    cluster counts as one value like any other. A document without words is
    one piece of 0 words without a bin. Rows that repeat an id are packed each
    on its own and, being copies, into different bins; a row without an id is
    packed too. Other columns are ignored. An empty table gives an empty result.
    """
    own = F.lit(None).cast("long") if cluster_col is None else F.xxhash64(F.col(cluster_col))
    base = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(F.col(text_col), own).alias("h"),
                       F.col(source_col).cast("string").alias("source"), F.col(text_col).alias("text"))
    sized = arrow_map(base, _measure, "doc_id long, h long, source string, n_words long, cluster long")
    if cluster_col is not None:
        keys = docs.select(F.col(id_col).cast("long").alias("k0"), F.xxhash64(F.col(text_col), own).alias("k1"),
                           own.alias("cluster")).distinct()
        sized = (sized.drop("cluster").join(keys, F.expr("doc_id <=> k0 and h = k1"), "left")
                 .select("doc_id", "h", "source", "n_words", "cluster"))
    shards = max(1, -(-docs.count() // shard_docs))
    dealt = (sized.withColumn("shard", F.pmod(F.xxhash64("doc_id", "h"), F.lit(shards)))
             .withColumn("tail", F.col("n_words") % capacity).repartition("shard")
             .sortWithinPartitions("shard", F.desc("tail"), "doc_id", "h"))
    return arrow_map(dealt, _pack(capacity), "doc_id long, piece long, start_word long, n_words long, bin_id long, "
                     "source string, cluster long")
