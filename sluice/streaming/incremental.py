"""Incremental INC load from the raw zone with Structured Streaming.

The raw zone is append-only (one extract per run, S5). A file-source stream
with ``trigger(availableNow=True)`` picks up every raw file not processed yet,
in micro-batches (of at most ``max_files_per_trigger`` files, if given), and
``foreachBatch`` feeds each to the bucketed upsert (K4); rows with a NULL key
go to the table's quarantine folder. The stream checkpoint records which files were applied, so a
restarted or retried run neither skips nor re-applies an extract (and a
re-applied micro-batch is harmless anyway: the upsert is idempotent).

A merge rewrites the touched folders, by hash nearly all of the table, however
small the micro-batch. So micro-batches wait as Parquet folders beside the
stream's offsets, ordered by batch number, until they are as large as the table;
then, and at the end of the run, one upsert merges them. Each merge costs at
most a fixed multiple of the rows it brings, so a run's work grows with its
input and not with its micro-batches times the table. What waits survives a
crash and is merged by the next run.

A run is named by the stream's own id (kept in its checkpoint) and the batch
number, so streams into one table, or one started over, never replace each other's
quarantined rows.

Make the result independent of micro-batch order by putting the load
sequence into the precombine ordering (e.g. ``["ds_load_ts", "load_seq"]``).
"""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from ..operators.dedup import latest_per_key
from ..sinks.files import file_system, read_bytes, remove
from ..sinks.upsert import folder_paths, quarantine_rows, read_meta, split_null_keys, table_exists, upsert

EPOCH = "sluice_epoch"
_WAITING = "_sluice_waiting"


def _bytes(spark: SparkSession, path: str) -> int:
    """Bytes of the files below ``path``; 0 when it is not there."""
    fs, p = file_system(spark, path)
    return int(fs.getContentSummary(p).getLength()) if fs.exists(p) else 0


def _table_bytes(spark: SparkSession, path: str) -> int:
    return sum(_bytes(spark, at) for at in folder_paths(path, read_meta(spark, path)).values())


def _waiting_epochs(spark: SparkSession, waiting: str) -> list[int]:
    fs, p = file_system(spark, waiting)
    names = [f.getPath().getName() for f in fs.listStatus(p)] if fs.exists(p) else []
    return sorted(int(n.split("=", 1)[1]) for n in names if n.startswith(f"{EPOCH}="))


def _merge_waiting(spark: SparkSession, waiting: str, schema: StructType, target_path: str, keys: Sequence[str],
                   precombine: Sequence[str], stream: str, num_buckets: int) -> None:
    """One upsert of all waiting micro-batches; of rows equal in key and
    ordering the one of the later micro-batch wins, as if applied in turn."""
    epochs = _waiting_epochs(spark, waiting)
    if not epochs:
        return
    rows = (spark.read.option("basePath", waiting).schema(StructType([*schema.fields, StructField(EPOCH, LongType())]))
            .parquet(*[f"{waiting}/{EPOCH}={e}" for e in epochs]))
    meta = read_meta(spark, target_path)
    types = StructType.fromJson(meta["schema"])
    rows = rows.withColumns({k: F.col(k).cast(types[k].dataType) for k in keys})
    identity = [*meta["partition_by"], *[k for k in keys if k not in meta["partition_by"]]]
    newest = latest_per_key(rows, identity, [*precombine, EPOCH]).drop(EPOCH)
    upsert(spark, newest, target_path, keys, precombine, run_id=f"stream-{stream}-{epochs[-1]:08d}-merge",
           num_buckets=num_buckets)
    # Oldest first: what a crash leaves here is newer than all that is gone, so merging it again changes nothing.
    for e in epochs:
        remove(spark, f"{waiting}/{EPOCH}={e}")


def upsert_stream(spark: SparkSession, raw_path: str, schema: StructType, target_path: str,
                  keys: Sequence[str], precombine: Sequence[str], checkpoint: str,
                  num_buckets: int, max_files_per_trigger: int | None = None,
                  wait: bool = True):
    """Apply every new raw file under ``raw_path`` to the table at ``target_path``.

    The table holds all of them when the call returns; with ``wait=False``
    there is no such end, and every micro-batch is merged at once.
    """
    reader = spark.readStream.schema(schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    src = reader.parquet(raw_path)

    waiting = f"{checkpoint}/{_WAITING}"

    def stream_id() -> str:
        return json.loads(read_bytes(spark, f"{checkpoint}/metadata").decode())["id"]

    def merge_waiting() -> None:
        _merge_waiting(spark, waiting, schema, target_path, keys, precombine, stream_id(), num_buckets)

    def apply(batch: DataFrame, epoch_id: int) -> None:
        run_id = f"stream-{stream_id()}-{epoch_id:08d}"
        if not table_exists(spark, target_path):
            upsert(spark, batch, target_path, keys, precombine, run_id=run_id, num_buckets=num_buckets)
            return
        keyed, keyless = split_null_keys(batch, keys, read_meta(spark, target_path)["partition_by"])
        quarantine_rows(spark, keyless, target_path, run_id)
        keyed.write.mode("overwrite").parquet(f"{waiting}/{EPOCH}={epoch_id}")
        if not wait or _bytes(spark, waiting) >= _table_bytes(spark, target_path):
            merge_waiting()

    q = (src.writeStream.foreachBatch(apply)
         .option("checkpointLocation", checkpoint)
         .trigger(availableNow=True)
         .start())
    if wait:
        q.awaitTermination()
        merge_waiting()
    return q
