"""Approximate nearest neighbours by learned partitions.

Fit, on a bounded sample of distinct vectors: the sample's neighbour graph is
cut into equally large cells with few edges between them, and a small network
learns, for a vector, the distribution of its neighbours over the cells. The
held-out part of the sample sets the number of cells a query must visit.

Index: every distinct vector of the table goes to its most probable cell, with
its smallest ids (copies further back can't be among the nearest). Cells that
hold many vectors are split into blocks by hash. Search: every distinct query
vector is routed to all blocks of its most probable cells, where the distances
to all vectors are computed; the blocks' best are merged.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sluice.llm._stage import arrow_map, staged
from sluice.llm._text import sorted_groups

NEAREST = 10
QUERY_EVERY = 100
SAMPLE = 16_384  # the fit sees at most so many distinct vectors
HELD_OUT = 8  # every 8th of them only measures recall
CELL_ROWS = 1_000  # distinct vectors a cell should hold ...
MAX_CELLS = 256  # ... with at most so many cells
RECALL = 0.93  # of the held-out vectors' neighbours, in the visited cells
BLOCK_BYTES = 32 << 20  # of a block's vectors; a query is copied once per block it visits
AT_ONCE = 1 << 22  # distances held at a time
GRAPH = 10
SLACK = 1.05  # a cell's size over the mean, in the graph cut
HIDDEN = 128
EPOCHS = 12
SEED = 20240229


def neighbour_graph(x: np.ndarray, q: np.ndarray, k: int, same: bool) -> np.ndarray:
    """Indexes in ``x`` of the ``k`` nearest of every row of ``q`` (leaving out
    the row itself if ``same``), in blocks of 1,024 queries."""
    k = max(1, min(k, len(x) - int(same)))
    norms = (x * x).sum(axis=1)
    out = np.empty((len(q), k), np.int64)
    for lo in range(0, len(q), 1024):
        d = norms - 2 * (q[lo:lo + 1024] @ x.T)
        if same:
            d[np.arange(len(d)), np.arange(lo, lo + len(d))] = np.inf
        out[lo:lo + 1024] = np.argpartition(d, k - 1, axis=1)[:, :k]
    return out


def balanced_cells(x: np.ndarray, graph: np.ndarray, cells: int, rounds: int = 20) -> tuple[np.ndarray, np.ndarray]:
    """(cell of every node, neighbours per node and cell).

    Start: halves along the principal direction, again and again. Then, per
    round, nodes move to the cell of most of their neighbours, greatest gain
    first, as long as that cell has room.
    """
    n = len(x)
    cell = np.zeros(n, np.int64)
    parts = 1
    while parts < cells:
        for p in range(parts):
            at = np.flatnonzero(cell == p)
            if len(at) > 1:
                y = x[at] - x[at].mean(axis=0)
                axis = np.linalg.eigh(y.T @ y)[1][:, -1]
                cell[at[np.argsort(y @ axis, kind="stable")[len(at) // 2:]]] += parts
        parts *= 2
    room = int(np.ceil(n / cells * SLACK))
    a = np.repeat(np.arange(n), graph.shape[1])
    ends = np.concatenate([a, graph.ravel()]), np.concatenate([graph.ravel(), a])
    for r in range(rounds + 1):
        near = np.bincount(ends[0] * cells + cell[ends[1]], minlength=n * cells).reshape(n, cells)
        if r == rounds:
            break
        best = near.argmax(axis=1)
        gain = near[np.arange(n), best] - near[np.arange(n), cell]
        sizes = np.bincount(cell, minlength=cells)
        moved = 0
        for i in np.argsort(-gain, kind="stable"):
            if gain[i] <= 0:
                break
            if sizes[best[i]] < room:
                sizes[best[i]] += 1
                sizes[cell[i]] -= 1
                cell[i] = best[i]
                moved += 1
        if not moved:
            break
    return cell, near


@dataclass
class Router:
    """A network with one hidden layer: a vector's probable cells."""
    mean: np.ndarray
    scale: np.ndarray
    w1: np.ndarray
    b1: np.ndarray
    w2: np.ndarray
    b2: np.ndarray
    probes: int = 1

    def logits(self, x: np.ndarray) -> np.ndarray:
        z = np.clip((x - self.mean) / self.scale, -1e3, 1e3)
        return np.maximum(z @ self.w1 + self.b1, 0) @ self.w2 + self.b2

    def cells(self, x: np.ndarray, n: int) -> np.ndarray:
        """The ``n`` most probable cells of every row, most probable first."""
        return np.argsort(-self.logits(x), axis=1, kind="stable")[:, :n]


def train_router(x: np.ndarray, target: np.ndarray) -> Router:
    """Cross entropy against the neighbours' distribution over cells, by Adam."""
    rng = np.random.default_rng(SEED)
    d, cells = x.shape[1], target.shape[1]
    scale = x.std(axis=0)
    net = Router(x.mean(axis=0), np.where(scale > 0, scale, 1),
                 rng.normal(0, np.sqrt(2 / d), (d, HIDDEN)), np.zeros(HIDDEN),
                 rng.normal(0, np.sqrt(1 / HIDDEN), (HIDDEN, cells)), np.zeros(cells))
    z = np.clip((x - net.mean) / net.scale, -1e3, 1e3)
    names = ("w1", "b1", "w2", "b2")
    first, second = ({p: np.zeros_like(getattr(net, p)) for p in names} for _ in range(2))
    step = 0
    for _ in range(EPOCHS):
        order = rng.permutation(len(x))
        for lo in range(0, len(x), 128):
            at = order[lo:lo + 128]
            hidden = np.maximum(z[at] @ net.w1 + net.b1, 0)
            out = hidden @ net.w2 + net.b2
            p = np.exp(out - out.max(axis=1, keepdims=True))
            p /= p.sum(axis=1, keepdims=True)
            g = (p - target[at]) / len(at)
            back = (g @ net.w2.T) * (hidden > 0)
            grads = {"w1": z[at].T @ back, "b1": back.sum(axis=0), "w2": hidden.T @ g, "b2": g.sum(axis=0)}
            step += 1
            for name, grad in grads.items():
                first[name] = 0.9 * first[name] + 0.1 * grad
                second[name] = 0.999 * second[name] + 0.001 * grad * grad
                rate = 2e-3 * np.sqrt(1 - 0.999 ** step) / (1 - 0.9 ** step)
                setattr(net, name, getattr(net, name) - rate * first[name] / (np.sqrt(second[name]) + 1e-8))
    return net


def fit_router(sample: np.ndarray, rows: int) -> Router:
    """Cells, network and number of visited cells for a table of ``rows`` distinct vectors."""
    cells = 1
    while cells < MAX_CELLS and cells * 2 * CELL_ROWS <= rows:
        cells *= 2
    held = np.arange(len(sample)) % HELD_OUT == HELD_OUT - 1
    x, q = sample[~held], sample[held]
    if cells == 1 or len(x) < 2 * cells or not len(q):
        d = sample.shape[1]
        return Router(np.zeros(d), np.ones(d), np.zeros((d, 1)), np.zeros(1), np.zeros((1, 1)), np.zeros(1))
    cell, near = balanced_cells(x, neighbour_graph(x, x, GRAPH, True), cells)
    near = near + 2.0 * (np.arange(cells) == cell[:, None])
    net = train_router(x, near / near.sum(axis=1, keepdims=True))
    home = net.cells(x, 1)[:, 0]
    wanted = home[neighbour_graph(x, q, NEAREST, False)]
    place = np.argsort(net.cells(q, cells), axis=1)  # of every cell in the query's order
    at = np.take_along_axis(place, wanted, axis=1)
    net.probes = cells
    for n in range(1, cells):
        if (at < n).mean() >= RECALL:
            net.probes = n
            break
    return net


def _matrix(column: pa.Array, d: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, d)


def _route(net: Router, d: int, n: int, passed: list[str]):
    """Rows with their ``n`` most probable cells."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                cells = net.cells(_matrix(b.column("v"), d), n)
                took = b.select(passed).take(pa.array(np.repeat(np.arange(b.num_rows), cells.shape[1])))
                yield took.append_column("cell", pa.array(cells.ravel().astype(np.int32)))
    return run


def distances(x: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Euclidean distance of every row of ``x`` to ``q``; where the squares
    overflow, from scaled differences."""
    with np.errstate(over="ignore", invalid="ignore"):
        diff = x - q
        score = np.sqrt((diff * diff).sum(axis=1))
        for i in np.flatnonzero(~np.isfinite(score)):
            half = x[i] / 2 - q / 2
            top = np.abs(half).max()
            score[i] = 2 * (top * np.sqrt(((half / top) ** 2).sum()))
    return score


def _search(d: int):
    """Best of every query in its block; a group has its vectors first, then the queries."""
    schema = pa.schema([("h", pa.int64()), ("sub", pa.int32()), ("need", pa.int32()), ("vec_id", pa.int64()),
                        ("score", pa.float64())])

    def of_block(rows: pa.Table) -> Iterator[pa.RecordBatch]:
        is_query = rows.column("is_query").to_numpy()
        n = int((~is_query).sum())
        if n == 0 or n == len(is_query):
            return
        rows = rows.combine_chunks()
        x = _matrix(rows.column("v").slice(0, n).combine_chunks(), d)
        ids = rows.column("ids").slice(0, n).to_pylist()
        norms = (x * x).sum(axis=1)
        queries = rows.slice(n)
        q_all = _matrix(queries.column("v").combine_chunks(), d)
        need = queries.column("need").to_numpy()
        named = queries.select(["h", "sub", "need"]).to_batches()[0]
        step = max(1, min(512, AT_ONCE // n))
        for lo in range(0, len(q_all), step):
            q = q_all[lo:lo + step]
            with np.errstate(over="ignore", invalid="ignore"):
                own = (q * q).sum(axis=1)
                near = norms - 2 * (q @ x.T) + own[:, None]
                # Well above the rounding error of the expanded square.
                slack = 1e-14 * d * (norms.max() + own)
            line, found, scores = [], [], []
            for i in range(len(q)):
                k = min(int(need[lo + i]), n)
                row = near[i]
                bound = np.partition(row, k - 1)[k - 1] + 2 * slack[i]
                at = np.flatnonzero(~(row > bound))  # keeps what is not a number
                score = distances(x[at], q[i])
                best = sorted((s, v) for s, j in zip(score.tolist(), at.tolist(), strict=True) for v in ids[j])
                best = best[:int(need[lo + i])]
                line += [lo + i] * len(best)
                found += [v for _, v in best]
                scores += [s for s, _ in best]
            names = named.take(pa.array(line, pa.int64()))
            yield pa.RecordBatch.from_arrays([*names.columns, pa.array(found, pa.int64()),
                                              pa.array(scores, pa.float64())], schema=schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in sorted_groups(batches, ["cell", "block"]):
            yield from of_block(rows)
    return run


def _usable(v: Column) -> Column:
    """Not null, no null or non-finite component, not all zero."""
    finite = F.forall(v, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < F.lit(float("inf"))))
    return F.coalesce(v.isNotNull() & finite & F.exists(v, lambda c: c != 0), F.lit(False))


def nearest(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding",
            is_query: Column | None = None, k: int = NEAREST) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` nearest found of every query row.

    ``is_query`` is a condition on ``vec_id``; by default every id divisible by
    100. score is the Euclidean distance in doubles; ties go to the smaller
    id. Rows without an id, and vectors that are null, zero or hold null or
    non-finite components, take no part; neither do vectors of another length
    than most have (the longer one if two are as frequent). Equal rows count
    once; if an id has several vectors each is a candidate and, as a query,
    gets its own list. A query's own id is no candidate. A query without any
    candidate gives no row. Other columns are ignored; an empty table gives an
    empty result.
    """
    spark = vectors.sparkSession
    is_query = F.col("vec_id") % QUERY_EVERY == 0 if is_query is None else is_query
    v = F.col(f"`{vector_col}`").cast("array<double>")
    rows = vectors.select(F.col(f"`{id_col}`").cast("long").alias("vec_id"), v.alias("v")).filter(
        F.col("vec_id").isNotNull() & _usable(F.col("v")))
    sizes = rows.groupBy(F.size("v").alias("d")).count().orderBy(F.col("count").desc(), F.col("d").desc()).limit(1).collect()
    empty = "query_id long, rank int, vec_id long, score double"
    if not sizes:
        return spark.createDataFrame([], empty)
    d = int(sizes[0]["d"])
    rows = rows.filter(F.size("v") == d).withColumn("h", F.xxhash64("v"))

    # Distinct vectors with their k + 1 smallest ids: no query needs more of them.
    w = Window.partitionBy("h", "v").orderBy("vec_id")
    distinct = staged(rows.withColumn("place", F.dense_rank().over(w)).filter(F.col("place") <= k + 1)
                      .groupBy("h", "v").agg(F.array_sort(F.collect_set("vec_id")).alias("ids")), "distinct_vectors")
    n = distinct.count()
    # At most SAMPLE vectors come to the driver.
    sample = distinct.orderBy(F.xxhash64("h", F.lit(SEED)), "v").limit(SAMPLE).select("v").toArrow()
    net = fit_router(_matrix(sample.column("v").combine_chunks(), d), n)

    index = staged(arrow_map(distinct, _route(net, d, 1, ["h", "v", "ids"]),
                             "h long, v array<double>, ids array<long>, cell int"), "index")
    # One row per cell.
    block_rows = max(1, BLOCK_BYTES // (8 * d))
    blocks = (index.groupBy("cell").agg(F.ceil(F.count(F.lit(1)) / F.lit(block_rows)).cast("int").alias("blocks")))
    blocks = F.broadcast(staged(blocks, "cells"))
    rows_of = ["cell", "block", "is_query", "h", "sub", "need", "v", "ids"]
    index = index.join(blocks, "cell").select(
        "cell", F.pmod("h", "blocks").cast("int").alias("block"), F.lit(False).alias("is_query"), "h",
        F.lit(0).alias("sub"), F.lit(0).alias("need"), "v", "ids")

    # An id with several vectors may fill several places of its own list.
    queries = staged(rows.filter(is_query).distinct().withColumn(
        "own", F.count(F.lit(1)).over(Window.partitionBy("vec_id"))), "queries")
    # (h, sub) names a query vector: sub tells vectors of equal hash apart.
    asked = staged(queries.groupBy("h", "v").agg(F.max("own").alias("own"))
                   .withColumn("sub", F.row_number().over(Window.partitionBy("h").orderBy("v")))
                   .select("h", "sub", "v", (F.col("own") + F.lit(k)).cast("int").alias("need")), "asked")
    routed = (arrow_map(asked, _route(net, d, net.probes, ["h", "sub", "need", "v"]),
                        "h long, sub int, need int, v array<double>, cell int")
              .join(blocks, "cell")
              .withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - F.lit(1))))
              .select(*[F.lit(True).alias("is_query") if c == "is_query" else
                        F.lit(None).cast("array<long>").alias("ids") if c == "ids" else F.col(c) for c in rows_of]))
    met = (index.select(*rows_of).union(routed).repartition("cell", "block")
           .sortWithinPartitions("cell", "block", "is_query"))
    found = arrow_map(met, _search(d), "h long, sub int, need int, vec_id long, score double")
    best = (found.withColumn("place", F.row_number().over(Window.partitionBy("h", "sub").orderBy("score", "vec_id")))
            .filter(F.col("place") <= F.col("need")).groupBy("h", "sub")
            .agg(F.array_sort(F.collect_list(F.struct("score", "vec_id"))).alias("best")))
    lists = (queries.select("h", "v", "vec_id").join(asked.select("h", "v", "sub"), ["h", "v"])
             .select("h", "sub", F.col("vec_id").alias("query_id")).join(best, ["h", "sub"]))
    others = F.slice(F.filter("best", lambda b: b["vec_id"] != F.col("query_id")), 1, k)
    return (lists.select("query_id", F.posexplode(others).alias("at", "b"))
            .select("query_id", (F.col("at") + F.lit(1)).cast("int").alias("rank"), F.col("b.vec_id").alias("vec_id"),
                    F.col("b.score").alias("score")))
