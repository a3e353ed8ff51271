"""Data plane of one work item: apply a source extract to its lake table.

The control plane yields, per item, the load type, the primary-key list and
the precombine column (from the control table) and the lake path (from the
storage lookup). ``load_item`` is the per-item job: INC merges the extract
into the hash-bucketed table (K4); FULL replaces the table with the
extract's newest row per key (K3), in the same bucketed layout so later INC
loads can merge into it.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, Observation, Row, SparkSession
from pyspark.sql import functions as F

from ..operators.outcomes import run_summary
from ..sinks import lake
from ..sinks.files import exists
from ..sinks.upsert import (META_COLS, UpsertResult, create_table, read_meta, register_table, suggest_num_buckets,
                            table_exists, upsert)
from ..sources.tables import extract_raw

LOAD_TS = "ds_load_ts"


def key_list(spec: str | Sequence[str]) -> list[str]:
    """``"a, b,c"`` -> ``["a", "b", "c"]`` (the control table's key text)."""
    parts = spec.split(",") if isinstance(spec, str) else list(spec)
    keys = [p.strip() for p in parts if p and p.strip()]
    if not keys:
        raise ValueError("an INC/FULL item needs at least one primary-key column")
    return keys


UNKNOWN_BYTES = 1 << 60


def _size_bytes(df: DataFrame) -> int:
    """The planner's size estimate; fails where it has none (a JDBC source)."""
    n = int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())
    if n >= UNKNOWN_BYTES:
        raise ValueError("the source's size is unknown: num_buckets is required to create the table")
    return n


def load_item(spark: SparkSession, source: DataFrame, target_path: str, load_type: str,
              primary_key: str | Sequence[str], precombine: str | Sequence[str],
              run_started: dt.datetime, run_id: str | None = None,
              num_buckets: int | None = None) -> UpsertResult:
    """Apply ``source`` to the table at ``target_path``.

    A precombine column named ``ds_load_ts`` that the source lacks is the
    run's load timestamp: one literal for the whole run (K8). The bucket
    count of a new table is ``num_buckets``, or sized from the source's size
    if the planner knows it; an existing table keeps its own.
    """
    keys = key_list(primary_key)
    order = key_list(precombine)
    if LOAD_TS in order and LOAD_TS not in source.columns:
        source = source.withColumn(LOAD_TS, lake.load_ts(run_started))
    missing = [c for c in keys + order if c not in source.columns]
    if missing:
        raise ValueError(f"source lacks key/precombine column(s): {missing}")
    kind = (load_type or "").strip().upper()
    if kind not in ("INC", "FULL"):
        raise ValueError(f"unknown load type {load_type!r}; expected INC or FULL")
    if num_buckets is None:
        if table_exists(spark, target_path):  # fixed when the table was created
            num_buckets = int(read_meta(spark, target_path)["num_buckets"])
        else:
            num_buckets = suggest_num_buckets(_size_bytes(source))
    if kind == "INC":
        return upsert(spark, source, target_path, keys, order, run_id=run_id, num_buckets=num_buckets)
    lead = read_meta(spark, target_path)["partition_by"] if table_exists(spark, target_path) else []
    return create_table(spark, source, target_path, keys, order, num_buckets, run_id, partition_by=lead)


@dataclass
class ItemRun:
    outcomes: DataFrame  # one row per item: status, error_class, error, table, counts
    summary: DataFrame


_OUTCOME = ("item string, schema string, table_name string, load_type string, lake_path string, status string, error_class string, "
            "error string, rows_raw long, rows_written long, rows_quarantined long, catalog_table string, "
            "high_water string, run_started timestamp_ntz, run_id string")


def read_outcomes(spark: SparkSession, log_path: str) -> DataFrame:
    """Every outcome in the log, of all runs."""
    if not exists(spark, log_path):
        return spark.createDataFrame([], _OUTCOME)
    return spark.read.schema(_OUTCOME).option("recursiveFileLookup", True).parquet(log_path)


def _log_outcome(spark: SparkSession, log_path: str, outcome: dict) -> None:
    """One item's outcome, as soon as it is known; a repeated item replaces its own."""
    at = f"{log_path.rstrip('/')}/{outcome['run_id']}/{outcome['item']}"
    row = tuple(outcome[c.split()[0]] for c in _OUTCOME.split(", "))
    spark.createDataFrame([row], _OUTCOME).coalesce(1).write.mode("overwrite").parquet(at)


def item_extract(spark: SparkSession, source: DataFrame, item: Row, high_water: str | None = None) -> DataFrame:
    """The slice of ``source`` that belongs to ``item``.

    The control row says which: ``extract_filter`` is a predicate over the
    source's columns (``{banner}`` stands for the item's banner), and of a
    column ``watermark`` only values above ``high_water`` (the largest one landed before) are taken; both reach the
    scan. A row without them means the whole source. A watermark must grow: rows
    that arrive later with a value already landed are not seen.
    """
    row = item.asDict()
    if row.get("extract_filter"):
        source = source.filter(F.expr(row["extract_filter"].replace("{banner}", row.get("banner") or "")))
    mark = row.get("watermark")
    if mark and high_water is not None:
        source = source.filter(F.col(f"`{mark}`") > F.lit(high_water).cast(source.schema[mark].dataType))
    return source


def run_items(spark: SparkSession, items: DataFrame, source_of: Callable[[Row], DataFrame], raw_root: str,
              run_started: dt.datetime, run_id: str, lake_path_of: Callable[[Row], str] | None = None,
              database: str | None = None, comments: dict[str, str] | None = None,
              num_buckets: int | None = None, log_path: str | None = None, max_parallel: int = 4) -> ItemRun:
    """Load every resolved work item: raw extract, INC or FULL load, external table.

    Per item (``items`` as ``flow.resolve_items`` gives it): its slice of ``source_of(item)`` (``item_extract``) is
    landed in the raw zone, stamped with the run's one load timestamp, in a
    folder of this run (a repeated run replaces it); the landed rows, not the
    source, are applied to the lake table; an external table over it is
    registered or brought up to date, with the commit columns and with column
    comments (keys are marked). An item that fails, or that did not resolve,
    is an outcome and does not stop the rest.

    ``database`` may hold ``{schema}``, which stands for the item's schema.

    ``max_parallel`` items run at a time, each in its own scheduler pool (fair
    shares where the session's scheduler is FAIR) and job group. Each outcome is written to
    ``log_path`` (by default ``_outcomes`` below ``raw_root``) when its item ends.
    A run that is started again under its ``run_id`` after a lost driver goes
    on with the items that have no good outcome yet; one that was cut off
    in the middle is repeated from its extract, which changes nothing twice.
    The log also holds each item's high-water mark; of past runs only the
    latest good outcome of each item is needed, so older folders of the log may
    be deleted. The driver walks over the items, which are jobs, not rows: the control table bounds them.
    """
    log_path = log_path or f"{raw_root.rstrip('/')}/_outcomes"
    past = read_outcomes(spark, log_path)
    done = {r["item"] for r in past.filter((F.col("run_id") == run_id) & (F.col("status") == "ok"))
            .select("item").collect()}
    marks = {r["item"]: r["m"] for r in
             past.filter("status = 'ok' and high_water is not null").groupBy("item")
             .agg(F.max_by("high_water", F.struct("run_started", "run_id")).alias("m")).collect()}

    def load(name: str, item: Row) -> None:
        row = {"item": name, "schema": item["schema"], "table_name": item["table_name"],
               "load_type": item["load_type"], "lake_path": item["lake_path"], "status": item["status"],
               "error_class": item["error_class"], "error": item["error"], "rows_raw": None, "rows_written": None,
               "rows_quarantined": None, "catalog_table": None, "high_water": None,
               "run_started": run_started.replace(tzinfo=None), "run_id": run_id}
        if item["status"] == "ok":
            spark.sparkContext.setLocalProperty("spark.scheduler.pool", name)
            spark.sparkContext.setJobGroup(f"{run_id}:{name}", f"load {name}")
            try:
                row |= _load_one(name, item, marks.get(name))
            except Exception as e:  # an item's failure is its outcome
                row |= {"status": "error", "error_class": "load_failed", "error": f"{type(e).__name__}: {e}"}
        _log_outcome(spark, log_path, row)

    def load_all(table: list[tuple[str, Row]]) -> None:
        for name, item in table:
            if name not in done:
                load(name, item)

    def _load_one(name: str, item: Row, mark: str | None) -> dict:
        path = (lake_path_of or (lambda i: i["lake_path"]))(item)
        raw = f"{raw_root.rstrip('/')}/{name}/run={run_id}"
        # A FULL load replaces the table, so it takes the whole slice every time.
        column = item.asDict().get("watermark") if item["load_type"] == "INC" else None
        extract = extract_raw(item_extract(spark, source_of(item), item, mark if column else None), None, None,
                              lake.load_ts(run_started))
        top = F.max(F.col(f"`{column}`") if column else F.lit(None)).cast("string")
        obs = Observation(f"raw {name}")
        (extract.observe(obs, F.count(F.lit(1)).alias("n"), top.alias("top")).write.mode("overwrite").parquet(raw))
        landed = spark.read.schema(extract.schema).parquet(raw)
        result = load_item(spark, landed, path, item["load_type"], item["primary_key"],
                           item["precombine"] or LOAD_TS, run_started, run_id, num_buckets)
        catalog_table = (f"{database.format(schema=item['schema'])}.{item['table_name']}" if database
                         else item["table_name"])
        keys = set(key_list(item["primary_key"]))
        notes = {c: "commit column" for c in META_COLS} | dict(comments or {})
        notes |= {k: (notes[k] + " - " if k in notes else "") + "PRIMARY KEY" for k in keys}
        register_table(spark, catalog_table, path, notes)
        # An extract without new rows keeps the old mark.
        return {"lake_path": path, "rows_raw": int(obs.get["n"]), "catalog_table": catalog_table,
                "rows_written": int(result.metrics["rows_written"]),
                "rows_quarantined": int(result.metrics["rows_quarantined"]),
                "high_water": obs.get["top"] if obs.get["top"] is not None else (mark if column else None)}

    tables: dict[str, list[tuple[str, Row]]] = {}  # items of one table run one after another
    for i in items.collect():
        same = tables.setdefault(f"{i['schema']}.{i['table_name']}", [])
        same.append((f"{i['schema']}.{i['table_name']}-{len(same)}", i))
    with ThreadPoolExecutor(max_workers=max(1, max_parallel)) as pool:
        for f in [pool.submit(inheritable_thread_target(spark)(load_all), t) for t in tables.values()]:
            f.result()  # a failure to log is the run's own
    outcomes = read_outcomes(spark, log_path).filter(F.col("run_id") == run_id)
    return ItemRun(outcomes, run_summary(outcomes))
