"""Registered queries that write to the lake and read the result back.

Each call writes under a new folder below the shared root (the cluster's
``spark.checkpoint.dir``; a temporary folder only when that is unset, as in
local tests), so runs never see each other's files.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path
from ..sinks import lake
from ..sinks.upsert import (COMMIT_SEQNO, COMMIT_TIME, FILE_NAME, PARTITION_PATH, RECORD_KEY, quarantined,
                            snapshot, upsert)
from ..sources.tables import extract_raw, table, ts_ntz
from ..streaming.incremental import upsert_stream
from .queries import _ORDER_FINDINGS_SQL, _ORDERS_UPSERT_CTE, ORDER_COLS, orders_base_and_batch
from .registry import query

TEST_BUCKETS = 16
RUN_STARTED = dt.datetime(2024, 1, 2, 3, 4, 5)


@query("upsert_bucketed", ("K4", "K7", "S6", "A3"), sql=_ORDERS_UPSERT_CTE + """
SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority,
       ds_load_ts, 'o_orderkey:' || CAST(o_orderkey AS VARCHAR) AS _record_key
FROM merged
""")
def upsert_bucketed(spark: SparkSession, sf: str) -> DataFrame:
    """First load creates the hash-bucketed table; the change batch is then
    merged into the touched buckets only; the snapshot is read back."""
    path = scratch_path(spark, "orders_lake")
    base, batch = orders_base_and_batch(spark, sf)
    upsert(spark, base, path, ["o_orderkey"], ["ds_load_ts"], run_id="r0001",
           num_buckets=TEST_BUCKETS)
    upsert(spark, batch, path, ["o_orderkey"], ["ds_load_ts"], run_id="r0002")
    return snapshot(spark, path).select(*ORDER_COLS, "ds_load_ts", RECORD_KEY)


@query("full_load", ("K3", "K1"), sql="""
SELECT o_orderkey, o_orderstatus, o_totalprice, o_orderdate FROM orders
""")
def full_load_q(spark: SparkSession, sf: str) -> DataFrame:
    """Two FULL loads into one path: only the second snapshot remains."""
    path = scratch_path(spark, "orders_full")
    o = table(spark, sf, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice", "o_orderdate")
    lake.full_load(o.filter(F.col("o_orderstatus") == "F"), path)
    lake.full_load(o, path)
    return spark.read.parquet(path)


@query("reload_self", ("K1", "K3"), sql="""
SELECT o_orderkey, o_totalprice * 2 AS o_totalprice FROM orders
""")
def reload_self(spark: SparkSession, sf: str) -> DataFrame:
    """Overwrite a table with a transform of itself: the rows are staged
    first, so the input is never deleted before it is read."""
    path = scratch_path(spark, "orders_self")
    o = table(spark, sf, "orders").select("o_orderkey", "o_totalprice")
    lake.overwrite(o, path)
    cur = spark.read.parquet(path)
    lake.overwrite(cur.withColumn("o_totalprice", F.col("o_totalprice") * 2), path)
    return spark.read.parquet(path)


@query("external_table", ("K5", "S6"), sql="""
SELECT o_orderkey, o_totalprice, o_orderdate, o_orderstatus FROM orders
""")
def external_table(spark: SparkSession, sf: str) -> DataFrame:
    """Register an external Parquet table over a lake path (partitioned by
    status) and read it through the catalog."""
    path = scratch_path(spark, "orders_ext")
    o = table(spark, sf, "orders").select("o_orderkey", "o_totalprice", "o_orderdate", "o_orderstatus")
    lake.overwrite(o, path, partition_by=["o_orderstatus"])
    name = "sluice_ext_orders_" + path.rsplit("-", 1)[-1]
    lake.register_external_table(
        spark, name, path, o, partition_by=["o_orderstatus"],
        comments={"o_orderkey": "order key - PRIMARY KEY", "o_orderdate": "order date"})
    return spark.table(name)


@query("ingest_raw", ("S5", "K8", "K2"), sql="""
SELECT o_orderkey, o_custkey, o_totalprice, 'MAK' AS banner,
       TIMESTAMP '2024-01-02 03:04:05' AS ds_load_ts
FROM orders WHERE o_orderstatus = 'O'
UNION ALL
SELECT o_orderkey, o_custkey, o_totalprice, 'MDD' AS banner,
       TIMESTAMP '2024-01-02 03:04:05' AS ds_load_ts
FROM orders WHERE o_orderstatus <> 'O'
""")
def ingest_raw(spark: SparkSession, sf: str) -> DataFrame:
    """Two work items extract their slice of the source into the raw zone
    (append), each row stamped with the run's single load timestamp."""
    raw = scratch_path(spark, "raw_orders")
    src = table(spark, sf, "orders")
    ts = lake.load_ts(RUN_STARTED)
    is_open = F.col("o_orderstatus") == "O"
    for banner, slice_ in (("MAK", is_open), ("MDD", ~is_open)):
        ext = extract_raw(src, slice_,
                          ["o_orderkey", "o_custkey", "o_totalprice"], ts,
                          {"banner": F.lit(banner)})
        lake.append(ext, raw, partition_by=["banner"])
    return spark.read.parquet(raw).select("o_orderkey", "o_custkey", "o_totalprice", "banner",
                                          "ds_load_ts")


@query("stream_upsert", ("K4", "S5", "A3"), sql=_ORDERS_UPSERT_CTE + """
SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority,
       ds_load_ts
FROM merged
""")
def stream_upsert(spark: SparkSession, sf: str) -> DataFrame:
    """Base extract and change extract land in the raw zone; an availableNow
    stream applies them (two files per micro-batch) to the bucketed table."""
    root = scratch_path(spark, "stream")
    base, batch = orders_base_and_batch(spark, sf)
    raw = f"{root}/raw"
    lake.append(base.withColumn("load_seq", F.lit(0)), raw)
    lake.append(batch.withColumn("load_seq", F.lit(1)), raw)
    schema = spark.read.parquet(raw).schema
    upsert_stream(spark, raw, schema, f"{root}/table", ["o_orderkey"], ["ds_load_ts", "load_seq"],
                  checkpoint=f"{root}/_stream_ckpt", num_buckets=TEST_BUCKETS,
                  max_files_per_trigger=2)
    return snapshot(spark, f"{root}/table").select(*ORDER_COLS, "ds_load_ts")



@query("item_load", ("K4", "K8", "S5", "A3"), sql="""
WITH base AS (
  SELECT *, TIMESTAMP '2024-03-01 06:00:00' AS ds_load_ts FROM orders
  WHERE o_orderdate < TIMESTAMP '1999-01-01'),
batch AS (
  SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice + 1.0 AS o_totalprice,
         o_orderdate, o_orderpriority, TIMESTAMP '2024-03-02 06:00:00' AS ds_load_ts
  FROM orders WHERE o_orderdate >= TIMESTAMP '1998-01-01')
SELECT * FROM batch
UNION ALL
SELECT * FROM base WHERE o_orderkey NOT IN (SELECT o_orderkey FROM batch)
""")
def item_load(spark: SparkSession, sf: str) -> DataFrame:
    """Two daily INC runs of one work item through ``load_item``: each run
    stamps its extract with its single load timestamp (the precombine
    column), so the later run wins every key it carries."""
    from .ingest import load_item
    path = scratch_path(spark, "item_orders")
    o = table(spark, sf, "orders")
    day1 = o.filter(F.col("o_orderdate") < ts_ntz("1999-01-01"))
    day2 = (o.filter(F.col("o_orderdate") >= ts_ntz("1998-01-01"))
            .withColumn("o_totalprice", F.col("o_totalprice") + F.lit(1.0)))
    load_item(spark, day1, path, "INC", "o_orderkey", "ds_load_ts",
              dt.datetime(2024, 3, 1, 6, 0, 0), run_id="d1", num_buckets=TEST_BUCKETS)
    load_item(spark, day2, path, "INC", "o_orderkey", "ds_load_ts",
              dt.datetime(2024, 3, 2, 6, 0, 0), run_id="d2")
    return snapshot(spark, path).select(*ORDER_COLS, "ds_load_ts")


@query("snapshot_publish", ("K3", "K5", "S6"), sql="""
SELECT o_orderkey, o_orderstatus, o_totalprice, o_orderdate FROM orders
""")
def snapshot_publish(spark: SparkSession, sf: str) -> DataFrame:
    """Two FULL loads published as versioned snapshots of one catalog table:
    the table reads the second; the first stays intact for earlier readers."""
    base = scratch_path(spark, "orders_pub")
    name = "sluice_pub_orders_" + base.rsplit("-", 1)[-1]
    o = table(spark, sf, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice", "o_orderdate")
    lake.publish_snapshot(spark, o.filter(F.col("o_orderstatus") == "F"), name, base, "0001")
    lake.publish_snapshot(spark, o, name, base, "0002")
    return spark.table(name)


@query("quality_split_write", ("V3", "V1", "F2", "F3", "F4", "F5"), sql=_ORDER_FINDINGS_SQL + """
, agg AS (SELECT row_id, count(*) AS n, min(rule_pos) AS first_pos FROM f GROUP BY row_id)
SELECT o.o_orderkey, CASE WHEN a.n IS NULL THEN 'valid' ELSE 'rejected' END AS quality,
       CAST(coalesce(a.n, 0) AS INTEGER) AS n_findings,
       CASE a.first_pos WHEN 0 THEN 'priority_present' WHEN 1 THEN 'priority_parts'
                        WHEN 2 THEN 'status_ci' WHEN 3 THEN 'segment_upper' END AS first_rule
FROM orders o LEFT JOIN agg a ON a.row_id = o.o_orderkey
""")
def quality_split_write(spark: SparkSession, sf: str) -> DataFrame:
    """Valid and rejected orders written by one job as two partitions of one
    table (the at-scale form of the split), read back."""
    from ..operators import quality as Q
    from .queries import ORDER_RULES
    path = scratch_path(spark, "orders_quality")
    o = table(spark, sf, "orders").select("o_orderkey", "o_orderstatus", "o_orderpriority")
    Q.write_split(Q.flag(o, ORDER_RULES), path)
    t = spark.read.parquet(path)
    return t.select("o_orderkey", "quality", F.size(Q.FINDINGS).alias("n_findings"),
                    F.try_element_at(F.col(Q.FINDINGS), F.lit(1))["rule_id"].alias("first_rule"))


def _upsert_with(strategy: str):
    def run(spark: SparkSession, sf: str) -> DataFrame:
        path = scratch_path(spark, f"orders_{strategy}")
        base, batch = orders_base_and_batch(spark, sf)
        upsert(spark, base, path, ["o_orderkey"], ["ds_load_ts"], run_id="r0001", num_buckets=TEST_BUCKETS,
               splits=2)
        upsert(spark, batch, path, ["o_orderkey"], ["ds_load_ts"], run_id="r0002", strategy=strategy)
        return snapshot(spark, path).select(*ORDER_COLS, "ds_load_ts")
    run.__doc__ = f"The change batch merged by the {strategy} plan, whatever the sizes."
    return run


for _strategy in ("shuffle", "broadcast"):
    query(f"upsert_{_strategy}", ("K4", "A3", "S6"), sql=_ORDERS_UPSERT_CTE + """
SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority, ds_load_ts FROM merged
""")(_upsert_with(_strategy))


@query("upsert_quarantine", ("K4", "V3"), sql="""
SELECT o_custkey, o_totalprice, CASE WHEN o_orderpriority = '2-HIGH' THEN 'rejected' ELSE 'loaded' END AS zone
FROM orders
""")
def upsert_quarantine(spark: SparkSession, sf: str) -> DataFrame:
    """Urgent orders lose their key on the way in: table and quarantine
    together are the input, over a create and a merge."""
    path = scratch_path(spark, "orders_quarantine")
    o = table(spark, sf, "orders").select(
        F.when(F.col("o_orderpriority") != "2-HIGH", F.col("o_orderkey")).alias("k"), "o_custkey", "o_totalprice",
        "o_orderdate")
    early = F.col("o_orderdate") < ts_ntz("1997-01-01")
    upsert(spark, o.filter(early), path, ["k"], ["o_orderdate"], run_id="r1", num_buckets=TEST_BUCKETS)
    upsert(spark, o.filter(~early), path, ["k"], ["o_orderdate"], run_id="r2")
    cols = ["o_custkey", "o_totalprice"]
    return (snapshot(spark, path).select(*cols, F.lit("loaded").alias("zone"))
            .unionByName(quarantined(spark, path).select(*cols, F.lit("rejected").alias("zone"))))


@query("gate_findings", ("V2", "V1"), sql=_ORDER_FINDINGS_SQL + """
SELECT row_id, rule_id, offending FROM f
""")
def gate_findings(spark: SparkSession, sf: str) -> DataFrame:
    """An aborted run reports every finding, not a sample."""
    from ..operators import quality as Q
    from .queries import ORDER_RULES
    try:
        Q.gate(table(spark, sf, "orders"), ORDER_RULES, "o_orderkey",
               findings_path=scratch_path(spark, "findings"))
    except Q.ValidationError as e:
        return e.findings.select("row_id", "rule_id", "offending")
    raise AssertionError("the orders hold violations")


@query("mapping_first_wins", ("W1", "A1", "P1"), sql="""
SELECT arg_min('b' || o_orderkey, o_orderkey) AS bucket_id, lower(o_orderpriority) AS "dlTableName"
FROM orders GROUP BY lower(o_orderpriority)
""")
def mapping_first_wins(spark: SparkSession, sf: str) -> DataFrame:
    """The storage mapping of an export in many files, whose names are in row
    order: the first row of a table name wins."""
    from . import flow
    path = scratch_path(spark, "export")
    (table(spark, sf, "orders").repartitionByRange(4, "o_orderkey").sortWithinPartitions("o_orderkey")
     .select(F.lit("s").alias("databaseName"), F.upper("o_orderpriority").alias("tableName"),
             F.concat(F.lit("b"), F.col("o_orderkey").cast("string")).alias("bucket_name"))
     .write.option("header", True).csv(path))
    from ..sources.control import read_csv_text
    return flow.storage_mapping(read_csv_text(spark, path)).select("bucket_id", "dlTableName")


@query("control_to_lake", ("S5", "K3", "K4", "K5", "K7", "K8", "P7", "C1"), sql="""
WITH items AS (SELECT * FROM (VALUES ('mak_orders'), ('mdd_orders')) t(table_name)),
k AS (SELECT table_name, 'o_orderkey:' || o_orderkey AS record_key FROM orders, items
      UNION ALL SELECT 'msb_part', 'p_partkey:' || p_partkey FROM part)
SELECT table_name, record_key, TIMESTAMP '2024-01-02 03:04:05' AS ds_load_ts, true AS meta_ok FROM k
UNION ALL SELECT 'msb_missing', 'not_found', NULL, false
""")
def control_to_lake(spark: SparkSession, sf: str) -> DataFrame:
    """Control rows to loaded lake tables, by the flow's own functions: fan-out,
    names, lookup, raw extract, INC and FULL load, external tables; an item
    without storage is an outcome."""
    from . import flow
    from .ingest import run_items
    root = scratch_path(spark, "control_to_lake")
    control = spark.createDataFrame(
        [("orders", "MAK,MDD", "se", "dl_sales", "ORDERS", "INC", "ds_load_ts", "o_orderkey"),
         ("part", "MSB", "hs", "dl_sales", "PART", "FULL", "ds_load_ts", "p_partkey"),
         ("part", "MSB", "hs", "dl_sales", "MISSING", "INC", "ds_load_ts", "p_partkey")],
        "icdsTableName string, BANNER_NAME string, dataSensitivity string, dlSchemaName string, "
        "dlTableName string, tableLoadType string, keyPreCombine string, keyPrimaryKey string")
    export = spark.createDataFrame([("dl_sales", t, f"id-{t}") for t in ("MAK_ORDERS", "mdd_orders", "msb_part")],
                                   "databaseName string, tableName string, bucket_name string")
    items = flow.resolve_items(flow.work_items(control), flow.storage_mapping(export))
    tag = "t" + root.rsplit("-", 1)[-1]
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {tag}")
    run = run_items(spark, items, lambda i: table(spark, sf, i["source_table"]), f"{root}/raw", RUN_STARTED, "r1",
                    lake_path_of=lambda i: f"{root}/{i['bucket_id']}/{i['table_name']}", database=tag,
                    num_buckets=4)
    meta_ok = ((F.col(COMMIT_TIME) == "r1") & F.col(COMMIT_SEQNO).startswith("r1_")
               & (F.col(PARTITION_PATH) == F.concat(F.lit("b="), F.col("b").cast("string")))
               & F.col(FILE_NAME).rlike(r"^part-.*[.]parquet$"))
    parts = []
    for o in run.outcomes.filter("status = 'ok'").collect():  # the three items loaded above
        t = spark.table(o["catalog_table"]).withColumn(FILE_NAME, F.col("_metadata.file_name"))
        parts.append(t.select(F.lit(o["table_name"]).alias("table_name"), F.col(RECORD_KEY).alias("record_key"),
                              "ds_load_ts", meta_ok.alias("meta_ok")))
    failed = run.outcomes.filter("status != 'ok'").select(
        "table_name", F.col("error_class").alias("record_key"),
        F.lit(None).cast("timestamp_ntz").alias("ds_load_ts"), F.lit(False).alias("meta_ok"))
    out = failed
    for p in parts:
        out = out.unionByName(p)
    return out


@query("missing_values", ("F2", "F6", "X4", "X11", "X12", "P11"), sql="""
WITH v AS (SELECT o_orderkey, CASE o_orderkey % 6 WHEN 0 THEN NULL WHEN 1 THEN '' WHEN 2 THEN ' ' || chr(9)
             WHEN 3 THEN chr(160) || 'se' || chr(9) WHEN 4 THEN 'SE' ELSE 'zz' END AS v FROM orders)
SELECT o_orderkey, coalesce(trim(v, ' ' || chr(9) || chr(160)) = '', true) AS blank, v IS NULL AS missing,
       coalesce(lower(v) NOT IN ('se', 'hs'), true) AS violates, coalesce(lower(v), 'none') AS with_default,
       trim(v, ' ' || chr(9) || chr(160)) AS stripped
FROM v
""")
def missing_values(spark: SparkSession, sf: str) -> DataFrame:
    """NULL, empty, blank, tab and no-break-space values in one column."""
    from ..functions.codes import lower_or_default
    from ..functions.text import is_blank, py_strip
    from ..operators import quality as Q
    k = F.col("o_orderkey") % 6
    v = (F.when(k == 1, "").when(k == 2, " \t").when(k == 3, "\u00a0se\t").when(k == 4, "SE").when(k == 5, "zz"))
    o = table(spark, sf, "orders").select("o_orderkey", v.alias("v"))
    flagged = Q.flag(o, [Q.Rule("in", "v", "in_ci", allowed=("se", "hs"))])
    return flagged.select("o_orderkey", is_blank("v").alias("blank"), F.col("v").isNull().alias("missing"),
                          (F.size(Q.FINDINGS) > 0).alias("violates"),
                          lower_or_default("v", "none").alias("with_default"), py_strip("v").alias("stripped"))
