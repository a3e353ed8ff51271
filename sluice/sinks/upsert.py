"""INC load: upsert by composite key, newest precombine value wins (K4, A3, K7).

Table layout: Parquet folders ``sluice_version=<v>[/<p>=<value>]/b=<bucket>``,
where ``b = pmod(hash(keys), N)`` and ``p`` are optional leading partition
columns that never change for a key (a creation date, a region). Folders are
immutable. ``_sluice_table.json`` says which version of each folder is the
table, with the table's fixed properties (N, keys, leading columns, schema).

One upsert run:

1. Batch key columns are cast to the target's key types (the bucket hash
   depends on the type), rows with a NULL key are split off (quarantine).
2. The batch is reduced to its newest row per key (partial + final
   WindowGroupLimit: a hot key is cut to one row per map task before the
   shuffle) and frozen as Parquet in the shared checkpoint folder, so every
   later step sees the same rows.
3. The target is semi joined with the batch's distinct (leading columns,
   bucket): dynamic partition pruning reads only those folders. With a leading
   column that follows the change feed, a daily batch touches a few days'
   folders; by hash alone it touches most buckets.
4. Touched folders and batch are merged by one of two plans (``plan_upsert``):
   the *shuffle* merge (both shuffled once by folder, newer row per key kept)
   or the *broadcast* merge (no target row shuffled: broadcast semi/anti joins
   on the batch keys inside the target scan). Batch keys over the broadcast
   bound are merged in parts by folder, one after the other, each under it.
5. The merged rows are written as a new version of the touched folders, and the
   pointer file is replaced in one rename. Untouched folders keep their files.

Rows with a NULL key are never dropped: every run writes them to a quarantine
folder of the table (``quarantined`` reads them back) and counts them.

Failure model: nothing that a reader may hold is changed or deleted by a
write. A crash before the switch leaves the old table and unreferenced folders;
after it the new table is complete. Readers only read. A reader keeps the
version it opened until ``drop_old_versions`` is called. One writer per table
at a time; a writer that finds the pointer changed since it started fails
instead of switching.
"""

from __future__ import annotations

import json
import re
import time
import uuid
from collections import Counter
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from ..operators.dedup import latest_per_key
from ..session import shared_root
from .files import exists, file_system, hadoop_path, partition_folders, read_bytes, remove
from .lake import register_external_table

BUCKET_COL = "b"
SRC_COL = "__sluice_src"
COMMIT_TIME = "_commit_time"
COMMIT_SEQNO = "_commit_seqno"
RECORD_KEY = "_record_key"
PARTITION_PATH = "_partition_path"
FILE_NAME = "_file_name"
META_COLS = (COMMIT_TIME, COMMIT_SEQNO, RECORD_KEY, PARTITION_PATH)
VERSION_COL = "sluice_version"
_META_FILE = "_sluice_table.json"
_QUARANTINE = "_sluice_quarantine"
_SPLIT = "__sluice_split"
_BYTES = "__sluice_bytes"
_SPEC = "__sluice_folder"
_PART = "__sluice_part"


def bucket_of(keys: Sequence[str], num_buckets: int) -> Column:
    """Hash bucket of a composite key (Murmur3, as Spark bucketing)."""
    return F.pmod(F.hash(*[F.col(k) for k in keys]), F.lit(num_buckets)).cast("int")


def record_key(keys: Sequence[str]) -> Column:
    """K7 record key text ``k1:v1,k2:v2``."""
    parts = []
    for i, k in enumerate(keys):
        if i:
            parts.append(F.lit(","))
        parts += [F.lit(f"{k}:"), F.col(k).cast("string")]
    return F.concat(*parts)


def split_null_keys(df: DataFrame, keys: Sequence[str], partition_by: Sequence[str] = ()
                    ) -> tuple[DataFrame, DataFrame]:
    """(rows with every key present, rows with a NULL key). A partition column
    must hold some text too: a folder can't tell an empty value from none."""
    any_null = F.lit(False)
    for k in keys:
        any_null = any_null | F.col(k).isNull()
    for c in partition_by:
        any_null = any_null | F.col(c).isNull() | (F.col(c).cast("string") == "")
    return df.filter(~any_null), df.filter(any_null)


def merge_latest(base: DataFrame, batch: DataFrame, keys: Sequence[str],
                 precombine: Sequence[str | Column], tiebreak: Sequence[str | Column] = ()) -> DataFrame:
    """In-memory K4: newest row per key over ``base`` then ``batch``.

    Order: ``precombine`` (NULL lowest), then source (batch wins ties), then
    ``tiebreak``, then the remaining columns.
    """
    u = (base.withColumn(SRC_COL, F.lit(0))
         .unionByName(batch.withColumn(SRC_COL, F.lit(1))))
    order = list(precombine) + [SRC_COL] + list(tiebreak)
    return latest_per_key(u, keys, order).drop(SRC_COL)


def with_meta(df: DataFrame, keys: Sequence[str], run_id: str, partition_by: Sequence[str] = ()) -> DataFrame:
    """K7/K8-style meta columns for rows written by this run."""
    rk = record_key(keys)
    folders = []
    for c in (*partition_by, BUCKET_COL):
        folders += [F.lit(("/" if folders else "") + c + "="), F.coalesce(F.col(c).cast("string"), F.lit(""))]
    return df.select(
        F.lit(run_id).alias(COMMIT_TIME),
        F.concat(F.lit(run_id + "_"), F.hex(F.xxhash64(rk))).alias(COMMIT_SEQNO),
        rk.alias(RECORD_KEY),
        F.concat(*folders).alias(PARTITION_PATH),
        *[F.col(c) for c in df.columns],
    )


@dataclass
class UpsertResult:
    path: str
    run_id: str
    touched: list[str] | None  # folder names; None: all (create, FULL)
    metrics: dict = field(default_factory=dict)
    quarantine: DataFrame | None = None
    strategy: str = "create"

    @property
    def touched_buckets(self) -> list[int] | None:
        return None if self.touched is None else sorted({int(n.rsplit("=", 1)[1]) for n in self.touched})


def table_exists(spark: SparkSession, path: str) -> bool:
    return exists(spark, f"{path}/{_META_FILE}")


def read_meta(spark: SparkSession, path: str) -> dict:
    """The pointer: num_buckets, splits, keys, partition_by, schema (JSON),
    version (of the last switch), folders (name -> version) and sizes (version
    -> folders written)."""
    return json.loads(read_bytes(spark, f"{path}/{_META_FILE}").decode())


def read_num_buckets(spark: SparkSession, path: str) -> int:
    return int(read_meta(spark, path)["num_buckets"])


def _switch(spark: SparkSession, path: str, meta: dict) -> None:
    """Make ``meta`` the table's pointer, by one rename that replaces the old file."""
    fs, p = file_system(spark, f"{path}/{_META_FILE}")
    name = f"{_META_FILE}.{meta['version']}.tmp"
    tmp = hadoop_path(spark, f"{path}/{name}")
    out = fs.create(tmp, True)
    out.write(bytearray(json.dumps(meta).encode()))
    out.close()
    fs.delete(hadoop_path(spark, f"{path}/.{name}.crc"), False)  # a local file's checksum would be renamed apart
    fs_api = spark._jvm.org.apache.hadoop.fs
    how = spark.sparkContext._gateway.new_array(fs_api.Options.Rename, 1)
    how[0] = fs_api.Options.Rename.OVERWRITE
    fs_api.FileContext.getFileContext(p.toUri(), spark._jsc.hadoopConfiguration()).rename(
        fs.makeQualified(tmp), fs.makeQualified(p), how)


def _publish(spark: SparkSession, path: str, parts: Sequence[DataFrame], meta: dict, base: str | None) -> list[str]:
    """Write the rows of ``parts``, one after the other, as a new version of
    their folders, then switch to it.

    ``meta["folders"]`` are the folders that stay; ``base`` is the version the
    rows were made from. Returns the names of the new folders.
    """
    version = uuid.uuid4().hex[:16]
    columns = [*meta["partition_by"], BUCKET_COL]
    for rows in parts:
        rows.write.mode("append").partitionBy(*columns).parquet(f"{path}/{VERSION_COL}={version}")
    names = partition_folders(spark, f"{path}/{VERSION_COL}={version}", len(columns))
    now = read_meta(spark, path)["version"] if table_exists(spark, path) else None
    if now != base:
        raise RuntimeError(f"{path} was changed by another writer; nothing of this run is in the table")
    folders = {**meta["folders"], **dict.fromkeys(names, version)}
    sizes = {**meta.get("sizes", {}), version: len(names)}
    _switch(spark, path, {**meta, "version": version, "folders": folders,
                          "sizes": {v: sizes[v] for v in dict.fromkeys(folders.values())}})
    return names


def folder_paths(path: str, meta: dict) -> dict[str, str]:
    """Folder name -> full path, for the table as ``meta`` has it."""
    return {n: f"{path}/{VERSION_COL}={v}/{n}" for n, v in meta["folders"].items()}


def register_table(spark: SparkSession, name: str, path: str, comments: Mapping[str, str] | None = None) -> None:
    """K5 for the table at ``path``: the catalog's partitions follow the pointer."""
    meta = read_meta(spark, path)
    register_external_table(spark, name, path, _read_folders(spark, path, meta), [*meta["partition_by"], BUCKET_COL],
                            comments, folders=folder_paths(path, meta))


def drop_old_versions(spark: SparkSession, path: str, older_than_s: float) -> int:
    """Delete folders that the table no longer uses and that were last written
    more than ``older_than_s`` seconds ago (longer than any reader or writer
    runs). Returns how many were deleted."""
    meta = read_meta(spark, path)
    fs, p = file_system(spark, path)
    limit, n = (time.time() - older_than_s) * 1000, 0
    for v in fs.listStatus(p):
        if not v.getPath().getName().startswith(f"{VERSION_COL}="):
            continue
        version = v.getPath().getName().split("=", 1)[1]
        for name in partition_folders(spark, v.getPath().toString(), len(meta["partition_by"]) + 1):
            here = hadoop_path(spark, f"{v.getPath().toString()}/{name}")
            if meta["folders"].get(name) != version and fs.getFileStatus(here).getModificationTime() < limit:
                fs.delete(here, True)
                n += 1
    return n


def quarantine_rows(spark: SparkSession, rejected: DataFrame, path: str, run_id: str
                    ) -> tuple[int, DataFrame | None]:
    """Rows with a NULL key, kept below the table; a repeated run replaces its own."""
    folder = f"{path}/{_QUARANTINE}/{re.sub('[^A-Za-z0-9_.-]', '_', run_id)}"
    obs = Observation("quarantine")
    tagged = rejected.withColumn("run_id", F.lit(run_id))
    tagged.observe(obs, F.count(F.lit(1)).alias("n")).write.mode("overwrite").parquet(folder)
    n = int(obs.get["n"])
    if not n:
        remove(spark, folder)
        return 0, None
    return n, spark.read.schema(rejected.schema).parquet(folder)


def quarantined(spark: SparkSession, path: str) -> DataFrame | None:
    """All rows that runs on this table rejected for a NULL key, with ``run_id``
    (text); None when there are none."""
    fs, p = file_system(spark, f"{path}/{_QUARANTINE}")
    if not fs.exists(p) or not len(fs.listStatus(p)):
        return None
    return (spark.read.option("mergeSchema", True).option("recursiveFileLookup", True)
            .parquet(f"{path}/{_QUARANTINE}"))


def _read_folders(spark: SparkSession, path: str, meta: dict) -> DataFrame:
    schema = StructType.fromJson(meta["schema"])
    if not meta["folders"]:
        return spark.createDataFrame([], schema)
    # A version all of whose folders are the table is read by its one root.
    held = Counter(meta["folders"].values())
    whole = [v for v, n in held.items() if n == meta["sizes"][v]]
    folders = [f"{path}/{VERSION_COL}={v}" for v in whole]
    folders += [at for n, at in folder_paths(path, meta).items() if meta["folders"][n] not in whole]
    with_version = StructType([*schema.fields, StructField(VERSION_COL, StringType())])
    return spark.read.option("basePath", path).schema(with_version).parquet(*folders).select(*schema.names)


def snapshot(spark: SparkSession, path: str, with_file_name: bool = False) -> DataFrame:
    """The table as its pointer has it now. Reads only; later writes do not
    change what this frame returns."""
    df = _read_folders(spark, path, read_meta(spark, path))
    if with_file_name:
        df = df.withColumn(FILE_NAME, F.col("_metadata.file_name"))
    return df


def _business_columns(df: DataFrame) -> list[str]:
    return [c for c in df.columns if c not in META_COLS and c not in (BUCKET_COL, FILE_NAME)]


def _check_schema(batch: DataFrame, target: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Fail before any write when the batch does not fit the target; cast keys."""
    tgt = {f.name: f.dataType for f in target.schema.fields if f.name in _business_columns(target)}
    got = {f.name: f.dataType for f in batch.schema.fields}
    if set(tgt) != set(got):
        raise ValueError(
            f"batch columns differ from target: missing {sorted(set(tgt) - set(got))}, "
            f"extra {sorted(set(got) - set(tgt))}")
    for name, dt in tgt.items():
        if name not in keys and got[name] != dt:
            raise ValueError(f"column {name}: batch type {got[name].simpleString()} "
                             f"!= target type {dt.simpleString()}")
    return batch.select(*[F.col(c).cast(tgt[c]).alias(c) if c in keys else F.col(c)
                          for c in _business_columns(target)])


def _stored_keys(meta: dict, keys: Sequence[str], path: str) -> list[str]:
    """The table's own key order; the bucket hash depends on it."""
    if sorted(keys) != sorted(meta["keys"]):
        raise ValueError(f"{path} is keyed by {meta['keys']}, not by {list(keys)}")
    return list(meta["keys"])


def suggest_num_buckets(table_bytes: int, bucket_bytes: int = 512 << 20) -> int:
    """A bucket count for a table of ``table_bytes``: buckets of about
    ``bucket_bytes`` (one file each per write), rounded up to a power of two.
    Fixed at creation; a daily batch then rewrites only the buckets it hits."""
    n = max(1, -(-table_bytes // bucket_bytes))
    return 1 << (n - 1).bit_length()


def _spread(df: DataFrame, keys: Sequence[str], splits: int, partition_by: Sequence[str] = ()) -> DataFrame:
    """One exchange for a write by folder, with ``splits`` tasks per folder."""
    folder = [F.col(c) for c in (*partition_by, BUCKET_COL)]
    if splits <= 1:
        return df.repartition(*folder)
    return df.repartition(*folder, F.pmod(F.xxhash64(*[F.col(k) for k in keys]), F.lit(splits)))


def create_table(spark: SparkSession, df: DataFrame, path: str, keys: Sequence[str],
                 precombine: Sequence[str | Column], num_buckets: int,
                 run_id: str | None = None, tiebreak: Sequence[str | Column] = (),
                 splits: int = 1, partition_by: Sequence[str] = ()) -> UpsertResult:
    """First or FULL load of a bucketed target: the deduplicated batch becomes
    the table. ``df`` may read the table itself: its files stay. ``splits``
    tasks write each folder (fixed for the table, like ``num_buckets``).
    ``partition_by`` are leading columns that never change for a key; keys are
    unique within their values, as in any partitioned table. A table that has
    grown is dealt anew by a FULL load of its snapshot with another
    ``num_buckets``.

    Two exchanges, on purpose: the first (by key) is preceded by a per-task
    reduction to one row per key, so a key with a third of all rows costs one
    row per map task; the second deals the survivors to their folders.
    """
    run_id = run_id or uuid.uuid4().hex[:16]
    base = read_meta(spark, path)["version"] if table_exists(spark, path) else None
    lead = list(partition_by)
    clean, rejected = split_null_keys(df, keys, lead)
    latest = latest_per_key(clean, [*lead, *[k for k in keys if k not in lead]], list(precombine) + list(tiebreak))
    rows = with_meta(latest.withColumn(BUCKET_COL, bucket_of(keys, num_buckets)), keys, run_id, lead)
    # Partition columns last, as the partitioned reader returns them.
    last = [*lead, BUCKET_COL]
    schema = StructType([f for f in rows.schema.fields if f.name not in last] + [rows.schema[c] for c in last])
    n_rejected, quarantine = quarantine_rows(spark, rejected, path, run_id)
    obs = Observation("create")
    rows = rows.observe(obs, F.count(F.lit(1)).alias("rows_written"))
    meta = {"num_buckets": num_buckets, "splits": splits, "keys": list(keys), "partition_by": lead,
            "schema": schema.jsonValue(), "folders": {}}
    _publish(spark, path, [_spread(rows, keys, splits, lead)], meta, base)
    return UpsertResult(path, run_id, None, {**obs.get, "rows_quarantined": n_rejected}, quarantine)


# Merge strategy bounds. The shuffle merge moves every row of the touched
# folders through one exchange: cheap while that data is small, the
# bottleneck when it is large. So: touched data up to SHUFFLE_MAX_BYTES ->
# shuffle merge; larger touched data and batch keys of at most
# MERGE_BROADCAST_BYTES, measured -> broadcast merge (target never shuffled).
MERGE_BROADCAST_BYTES = 256 << 20
ROW_OVERHEAD = 64  # bytes of a hash relation's row besides its values
SHUFFLE_MAX_BYTES = 1 << 30


@dataclass
class UpsertPlan:
    merged: DataFrame | None  # the first part's rows
    quarantine: DataFrame
    meta: dict
    strategy: str = "none"
    staging: str | None = None
    parts: list[DataFrame] = field(default_factory=list)  # disjoint; written one after the other


def _shuffle_merge(existing: DataFrame, incoming: DataFrame, keys: Sequence[str],
                   precombine: Sequence[str | Column], splits: int = 1, partition_by: Sequence[str] = ()) -> DataFrame:
    """Target rows of the touched folders and batch rows, shuffled once by
    folder (and, with ``splits``, by key hash within it); newer row per key
    kept. Rewrites each touched folder as ``splits`` files."""
    both = existing.withColumn(SRC_COL, F.lit(0)).unionByName(incoming.withColumn(SRC_COL, F.lit(1)))
    # Shuffled by (folder, split) only: the window's clustering (folder, split,
    # keys) is already satisfied, so there is no second exchange.
    both = both.withColumn(_SPLIT, F.pmod(F.xxhash64(*[F.col(k) for k in keys]), F.lit(max(1, splits))))
    folder = [F.col(c) for c in (*partition_by, BUCKET_COL)]
    w = (Window.partitionBy(*folder, F.col(_SPLIT), *[F.col(k) for k in keys if k not in partition_by])
         .orderBy(*[(F.col(c) if isinstance(c, str) else c).desc_nulls_last() for c in precombine],
                  F.col(SRC_COL).desc()))
    return (both.repartition(*folder, F.col(_SPLIT))
            .withColumn("__rn", F.row_number().over(w))
            .filter(F.col("__rn") == 1)
            .drop("__rn", SRC_COL, _SPLIT))


def _broadcast_merge(existing: DataFrame, incoming: DataFrame, keys: Sequence[str],
                     precombine: Sequence[str | Column]) -> DataFrame:
    """Small batch: no target data is shuffled.

    1. Target (keys, precombine) only, joined to the broadcast batch keys:
       the batch rows whose target row is newer are the losers.
    2. Winners = batch minus losers (both bounded by the batch size).
    3. Target rows whose key a winner replaces are dropped by a broadcast
       anti join inside the scan's own tasks; winners are unioned in.
    Precombine tuples compare with the batch winning ties and NULL lowest,
    exactly as the window merge orders them.
    """
    keys = list(keys)
    pc = [F.col(c) if isinstance(c, str) else c for c in precombine]
    new_side = incoming.select(*keys, F.struct(*pc, F.lit(1)).alias("__pn"))
    old_side = existing.select(*keys, F.struct(*pc, F.lit(0)).alias("__po"))
    losers = (old_side.join(F.broadcast(new_side), keys)
              .filter(~(F.col("__pn") > F.col("__po"))).select(*keys))
    winners = incoming.join(F.broadcast(losers), keys, "left_anti")
    kept = existing.join(F.broadcast(winners.select(*keys)), keys, "left_anti")
    return kept.unionByName(winners)


def _merge_parts(folders: Sequence[tuple[str, int]], limit: int) -> list[tuple[list[str], int, int]]:
    """Parts (folders, slices, slice) of a merge whose batch keys are at most
    about ``limit`` bytes each: folders (name, bytes of batch keys) next to each
    other, or, of a folder that is larger by itself, one slice by key hash."""
    parts: list[tuple[list[str], int, int]] = []
    held = 0
    for name, size in folders:
        if size > limit:
            n = size * 5 // (4 * limit) + 1  # hash slices are not quite equal
            parts += [([name], n, k) for k in range(n)]
            held = limit
            continue
        if not parts or held + size > limit:
            parts.append(([], 1, 0))
            held = 0
        parts[-1][0].append(name)
        held += size
    return parts


def plan_upsert(spark: SparkSession, batch: DataFrame, path: str, keys: Sequence[str],
                precombine: Sequence[str | Column], run_id: str,
                tiebreak: Sequence[str | Column] = (), strategy: str = "auto",
                broadcast_bytes: int = MERGE_BROADCAST_BYTES,
                shuffle_max_bytes: int = SHUFFLE_MAX_BYTES, in_parts: bool = False) -> UpsertPlan:
    """Build (without writing) the merged rows of the touched folders.

    ``strategy``: ``"shuffle"`` (window merge per folder), ``"broadcast"`` (no
    target shuffle; the batch's keys must be small) or ``"auto"``: broadcast
    when the touched folders hold more than ``shuffle_max_bytes`` and the
    batch's keys and ordering values at most ``broadcast_bytes`` (measured while the
    batch is frozen); shuffle otherwise. Touched bytes are estimated from the
    table size in the file listing the driver already holds, times the share
    of touched folders. Jobs run here: the batch's write (which also counts
    and measures it) and the list of its folders.

    A broadcast merge whose batch keys are over ``broadcast_bytes`` is an error
    unless ``in_parts``: then it is planned as several merges of some folders
    each (of a slice by key hash of a single large folder), whose batch keys
    are under it. Which folders go together is decided on the driver from one
    row per touched folder, which is what the table's pointer holds too.
    """
    meta = read_meta(spark, path)
    n, keys, splits = int(meta["num_buckets"]), _stored_keys(meta, keys, path), int(meta["splits"])
    lead = list(meta["partition_by"])
    if strategy not in ("auto", "shuffle", "broadcast"):
        raise ValueError(f"unknown merge strategy {strategy!r}")
    target = _read_folders(spark, path, meta)
    batch = _check_schema(batch, target, keys)
    identity = [*lead, *[k for k in keys if k not in lead]]
    clean, quarantine = split_null_keys(batch, keys, lead)

    # Newest row per key inside the batch (pre-reduced before the shuffle),
    # then frozen as a Parquet table in the shared checkpoint folder (the
    # cluster's spark.checkpoint.dir): its size, the touched folders and the
    # merge all see the same rows even if the source changes between jobs (a
    # re-read that put a row into an untouched folder would replace that
    # folder by this row alone). Parquet, not RDD checkpoint(): columnar
    # write, vectorised read-back.
    latest = latest_per_key(clean, identity, list(precombine) + list(tiebreak))
    latest = latest.withColumn(BUCKET_COL, bucket_of(keys, n))
    obs = Observation("batch")
    held = [F.octet_length(F.coalesce(F.col(k).cast("string"), F.lit(""))) for k in identity]
    held += [F.octet_length(F.coalesce((F.col(c) if isinstance(c, str) else c).cast("string"), F.lit("")))
             for c in precombine]
    width = sum(held[1:], held[0]) + F.lit(ROW_OVERHEAD + 8 * len(held))
    staged = f"{shared_root(spark)}/_sluice_staging/{run_id}-{uuid.uuid4().hex[:12]}"
    (latest.observe(obs, F.count(F.lit(1)).alias("rows"), F.coalesce(F.sum(width), F.lit(0)).alias("bytes"))
     .write.parquet(f"{staged}/rows"))
    latest = spark.read.schema(latest.schema).parquet(f"{staged}/rows")
    if int(obs.get["rows"]) == 0:
        return UpsertPlan(None, quarantine, meta, staging=staged)
    key_bytes = int(obs.get["bytes"])

    # One row per folder that the batch touches. The comparison makes the side
    # count as selective, so the planner prunes the scan by it at run time.
    folder = [*lead, BUCKET_COL]
    seen = Observation("folders")
    touched = latest.groupBy(*folder).agg(F.sum(width).cast("long").alias(_BYTES)).coalesce(1)
    touched.observe(seen, F.count(F.lit(1)).alias("n")).write.parquet(f"{staged}/folders")
    touched = spark.read.schema(touched.schema).parquet(f"{staged}/folders").filter(F.col(BUCKET_COL) >= 0)
    incoming = with_meta(latest, keys, run_id, lead)

    def touched_rows(folders: DataFrame) -> DataFrame:
        return target.join(F.broadcast(folders.select(*folder)), folder, "left_semi").select(*target.columns)

    existing = touched_rows(touched)
    if strategy == "broadcast" and key_bytes > broadcast_bytes:
        if not in_parts:
            remove(spark, staged)
            raise ValueError(f"batch keys of {key_bytes} bytes are over the broadcast bound of {broadcast_bytes}")
        spec = F.to_json(F.array(*[F.col(c).cast("string") for c in folder]))
        by_name = [(r[0], r[1]) for r in touched.select(spec, _BYTES).orderBy(*folder).collect()]
        parts = _merge_parts(by_name, broadcast_bytes)
        listed = [(name, k) for k, (names, _, _) in enumerate(parts) for name in names]
        (touched.join(F.broadcast(spark.createDataFrame(listed, f"{_SPEC} string, {_PART} int")),
                      F.col(_SPEC) == spec).select(*folder, _PART).coalesce(1).write.parquet(f"{staged}/parts"))
        dealt = spark.read.parquet(f"{staged}/parts")
        merges = []
        for k, (_, slices, piece) in enumerate(parts):
            mine = dealt.filter(F.col(_PART) == k)
            sides = [touched_rows(mine), incoming.join(F.broadcast(mine.select(*folder)), folder, "left_semi")
                     .select(*incoming.columns)]
            if slices > 1:
                here = F.pmod(F.xxhash64(*[F.col(c) for c in identity]), F.lit(slices)) == piece
                sides = [s.filter(here) for s in sides]
            merges.append(_broadcast_merge(*sides, identity, precombine))
        return UpsertPlan(merges[0], quarantine, meta, strategy, staged, merges)
    if strategy == "auto":
        table_bytes = int(target._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())
        touched_bytes = table_bytes * min(int(seen.get["n"]), len(meta["folders"])) // max(1, len(meta["folders"]))
        strategy = "broadcast" if touched_bytes > shuffle_max_bytes and key_bytes <= broadcast_bytes else "shuffle"
    if strategy == "broadcast":
        merged = _broadcast_merge(existing, incoming, identity, precombine)
    else:
        merged = _shuffle_merge(existing, incoming, keys, precombine, splits, lead)
    return UpsertPlan(merged, quarantine, meta, strategy, staged, [merged])


def upsert(spark: SparkSession, batch: DataFrame, path: str, keys: Sequence[str],
           precombine: Sequence[str | Column], run_id: str | None = None,
           tiebreak: Sequence[str | Column] = (), num_buckets: int | None = None,
           strategy: str = "auto", splits: int = 1, partition_by: Sequence[str] = (), **plan_options) -> UpsertResult:
    """K4: apply ``batch`` to the bucketed table at ``path``.

    Creates the table when it does not exist (``num_buckets`` required then;
    ``splits`` and ``partition_by`` are fixed then too). An existing table
    keeps its own keys, in its own order: a batch keyed by other columns fails
    before anything is written.
    """
    run_id = run_id or uuid.uuid4().hex[:16]
    if not table_exists(spark, path):
        fs, p = file_system(spark, path)
        own = ("_sluice_", f"{VERSION_COL}=")
        if fs.exists(p) and any(not f.getPath().getName().startswith(own) for f in fs.listStatus(p)):
            raise ValueError(f"{path} holds files but is not a bucketed upsert table; "
                             "refusing to overwrite it")
        if num_buckets is None:
            raise ValueError(f"no table at {path}; num_buckets is required to create it")
        return create_table(spark, batch, path, keys, precombine, num_buckets, run_id, tiebreak, splits, partition_by)

    plan = plan_upsert(spark, batch, path, keys, precombine, run_id, tiebreak, strategy=strategy,
                       **{"in_parts": True, **plan_options})
    try:
        n_rejected, quarantine = quarantine_rows(spark, plan.quarantine, path, run_id)
        if plan.merged is None:
            return UpsertResult(path, run_id, [], {"rows_written": 0, "rows_quarantined": n_rejected},
                                quarantine, "none")
        seen = [Observation(f"upsert_{k}") for k in range(len(plan.parts))]
        parts = [part.observe(
            obs, F.count(F.lit(1)).alias("rows_written"),
            F.count_if(F.col(COMMIT_TIME) == F.lit(run_id)).alias("rows_from_batch"))
            for part, obs in zip(plan.parts, seen, strict=True)]
        touched = _publish(spark, path, parts, plan.meta, plan.meta["version"])
        totals = {k: sum(int(obs.get[k]) for obs in seen) for k in ("rows_written", "rows_from_batch")}
        return UpsertResult(path, run_id, touched, {**totals, "rows_quarantined": n_rejected}, quarantine,
                            plan.strategy)
    finally:
        if plan.staging:
            remove(spark, plan.staging)  # the frozen batch
