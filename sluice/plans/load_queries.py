"""Registered queries of the load path: publishing under readers, loads by
folder, item runs, extracts, files by header, positions and metrics."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import quality as Q
from ..operators.lookup import key_guard, lookup
from ..operators.outcomes import with_outcome
from ..operators.topk import sorted_positions
from ..session import scratch_path
from ..sinks import lake
from ..sinks.upsert import create_table, read_meta, register_table, snapshot, upsert
from ..sources.control import parquet_with_row_number, read_csv_text
from ..sources.tables import table, ts_ntz
from .lake_queries import RUN_STARTED, TEST_BUCKETS
from .queries import _ORDER_FINDINGS_SQL, _ORDERS_UPSERT_CTE, ORDER_RULES, orders_base_and_batch, part_control_table
from .registry import query

_NEXT_DAY = dt.datetime(2024, 1, 3, 3, 4, 5)


@query("upsert_with_reader", ("K3", "K4", "S6"), sql=_ORDERS_UPSERT_CTE + """
SELECT 'before' AS seen, o_orderkey, o_totalprice FROM base
UNION ALL SELECT 'after INC', o_orderkey, o_totalprice FROM merged
UNION ALL SELECT 'after FULL', o_orderkey, o_totalprice FROM batch
""")
def upsert_with_reader(spark: SparkSession, sf: str) -> DataFrame:
    """Snapshots taken before, between and after an INC and a FULL load: each
    keeps the table as it was when it was opened."""
    path = scratch_path(spark, "orders_reader")
    base, batch = orders_base_and_batch(spark, sf)
    upsert(spark, base, path, ["o_orderkey"], ["ds_load_ts"], run_id="r1", num_buckets=TEST_BUCKETS)
    seen = [("before", snapshot(spark, path))]
    upsert(spark, batch, path, ["o_orderkey"], ["ds_load_ts"], run_id="r2")
    seen.append(("after INC", snapshot(spark, path)))
    create_table(spark, batch, path, ["o_orderkey"], ["ds_load_ts"], TEST_BUCKETS, "r3")
    seen.append(("after FULL", snapshot(spark, path)))
    out = None
    for name, df in seen:
        part = df.select(F.lit(name).alias("seen"), "o_orderkey", "o_totalprice")
        out = part if out is None else out.unionByName(part)
    return out


_RECENT_SQL = "o_orderdate >= (SELECT max(o_orderdate) - INTERVAL 20 DAY FROM orders)"


@query("upsert_by_month", ("K4", "K7"), sql=f"""
SELECT o_orderkey, CASE WHEN {_RECENT_SQL} THEN o_totalprice + 1 ELSE o_totalprice END AS o_totalprice,
       'o_month=' || strftime(o_orderdate, '%Y-%m') AS folder, true AS few_folders_touched
FROM orders
""")
def upsert_by_month(spark: SparkSession, sf: str) -> DataFrame:
    """A table led by the order month, an immutable attribute of the key: a
    change feed of the latest orders reads and rewrites their months' buckets
    only."""
    path = scratch_path(spark, "orders_by_month")
    o = table(spark, sf, "orders").select("o_orderkey", "o_totalprice", "o_orderdate",
                                          F.date_format("o_orderdate", "yyyy-MM").alias("o_month"))
    upsert(spark, o.withColumn("seq", F.lit(0)), path, ["o_orderkey"], ["seq"], run_id="r1", num_buckets=2,
           partition_by=["o_month"])
    last = o.agg(F.max("o_orderdate")).first()[0] - dt.timedelta(days=20)
    feed = (o.filter(F.col("o_orderdate") >= ts_ntz(last.isoformat(sep=" ")))
            .withColumn("o_totalprice", F.col("o_totalprice") + 1).withColumn("seq", F.lit(1)))
    result = upsert(spark, feed, path, ["o_orderkey"], ["seq"], run_id="r2")
    few = 5 * len(result.touched) < len(read_meta(spark, path)["folders"])
    return snapshot(spark, path).select(
        "o_orderkey", "o_totalprice", F.split("_partition_path", "/")[0].alias("folder"),
        F.lit(few).alias("few_folders_touched"))


def _items(spark: SparkSession, rows: list[tuple], root: str) -> DataFrame:
    """Resolved work items, by the flow's own functions."""
    from . import flow
    control = spark.createDataFrame(
        rows, "icdsTableName string, BANNER_NAME string, dataSensitivity string, dlSchemaName string, "
        "dlTableName string, tableLoadType string, keyPreCombine string, keyPrimaryKey string, "
        "extract_filter string, watermark string")
    items = flow.work_items(control)
    mapping = items.select(F.col("schema").alias("dlSchemaName"), F.col("table_name").alias("dlTableName"),
                           F.concat(F.lit("id-"), "table_name").alias("bucket_id"))
    return flow.resolve_items(items, mapping)


@query("items_resumed", ("C1", "C2", "S5", "K4"), sql="""
SELECT 'mak_orders' AS table_name, 'o_orderkey' AS key_name, o_orderkey AS key_value, 1 AS loads FROM orders
UNION ALL SELECT 'mdd_orders', 'o_orderkey', o_orderkey, 1 FROM orders
UNION ALL SELECT 'mak_customer', 'c_custkey', c_custkey, 2 FROM customer
UNION ALL SELECT 'mak_part', 'p_partkey', p_partkey, 1 FROM part
""")
def items_resumed(spark: SparkSession, sf: str) -> DataFrame:
    """A run of four items, two at a time, in which one source is lost; the run
    started again under its id loads only that one."""
    from .ingest import run_items
    root = scratch_path(spark, "items_resumed")
    items = _items(spark, [
        ("orders", "MAK,MDD", "se", "dl", "ORDERS", "INC", "ds_load_ts", "o_orderkey", None, None),
        ("customer", "MAK", "ns", "dl", "CUSTOMER", "INC", "ds_load_ts", "c_custkey", None, None),
        ("part", "MAK", "ns", "dl", "PART", "FULL", "ds_load_ts", "p_partkey", None, None)], root)
    tag = "r" + root.rsplit("-", 1)[-1]
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {tag}")
    loads: list[str] = []

    def source(item):
        loads.append(item["table_name"])
        if loads.count("mak_customer") == 1 and item["table_name"] == "mak_customer":
            raise ConnectionError("source is gone")
        return table(spark, sf, item["source_table"])

    for _ in range(2):
        run = run_items(spark, items, source, f"{root}/raw", RUN_STARTED, "r1", num_buckets=4, database=tag,
                        lake_path_of=lambda i: f"{root}/{i['table_name']}", max_parallel=2)
    out = None
    for o in run.outcomes.filter("status = 'ok'").collect():  # the four items
        key = next(c for c in ("o_orderkey", "c_custkey", "p_partkey") if c in spark.table(o["catalog_table"]).columns)
        part = spark.table(o["catalog_table"]).select(
            F.lit(o["table_name"]).alias("table_name"), F.lit(key).alias("key_name"),
            F.col(key).cast("long").alias("key_value"), F.lit(loads.count(o["table_name"])).alias("loads"))
        out = part if out is None else out.unionByName(part)
    return out


@query("extract_incremental", ("S5", "K8", "K4"), sql="""
WITH s AS (SELECT o_orderkey, o_totalprice, CASE WHEN o_orderstatus = 'O' THEN 'mak' ELSE 'mdd' END AS unit,
                  o_orderkey <= (SELECT median(o_orderkey) FROM orders) AS early FROM orders)
SELECT unit || '_orders' AS table_name, o_orderkey, o_totalprice,
       CASE WHEN early THEN TIMESTAMP '2024-01-02 03:04:05' ELSE TIMESTAMP '2024-01-03 03:04:05' END AS ds_load_ts
FROM s
""")
def extract_incremental(spark: SparkSession, sf: str) -> DataFrame:
    """Two daily runs over a source that grows in between: every item lands its
    own slice, and the second run only what lies above its high-water mark. The
    raw zone holds every row once, stamped by the run that landed it."""
    from .ingest import run_items
    root = scratch_path(spark, "extract_incremental")
    unit = F.when(F.col("o_orderstatus") == "O", "mak").otherwise("mdd")
    o = table(spark, sf, "orders").select("o_orderkey", "o_totalprice", unit.alias("unit"))
    half = o.agg(F.median("o_orderkey")).first()[0]
    items = _items(spark, [("orders", "MAK,MDD", "se", "dl", "ORDERS", "INC", "ds_load_ts", "o_orderkey",
                            "unit = '{banner}'", "o_orderkey")], root)
    items = items.withColumn("banner", F.lower("banner"))
    tag = "e" + root.rsplit("-", 1)[-1]
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {tag}")
    for run_id, at, part in (("d1", RUN_STARTED, F.col("o_orderkey") <= half),
                             ("d2", _NEXT_DAY, F.col("o_orderkey") > half)):
        lake.append(o.filter(part), f"{root}/source")
        run_items(spark, items, lambda i: spark.read.parquet(f"{root}/source"), f"{root}/raw", at, run_id,
                  num_buckets=4, database=tag, lake_path_of=lambda i: f"{root}/lake/{i['table_name']}")
    out = None
    for banner in ("mak", "mdd"):
        raw = spark.read.parquet(f"{root}/raw/dl.{banner}_orders-0").select(
            F.lit(f"{banner}_orders").alias("table_name"), "o_orderkey", "o_totalprice", "ds_load_ts")
        out = raw if out is None else out.unionByName(raw)
    return out


@query("csv_by_name", ("S1", "W1"), sql="""
SELECT CAST(o_orderkey AS VARCHAR) AS o_orderkey, o_orderstatus,
       CASE WHEN o_orderkey % 3 = 2 THEN NULL ELSE o_orderpriority END AS o_orderpriority,
       row_number() OVER (ORDER BY o_orderkey % 3, o_orderkey) AS row_num
FROM orders
""")
def csv_by_name(spark: SparkSession, sf: str) -> DataFrame:
    """Three CSV files of one control folder: another column order in the
    second, a column less in the third; rows are numbered over all files."""
    path = scratch_path(spark, "csv_by_name")
    o = table(spark, sf, "orders")
    for k, cols in enumerate((["o_orderkey", "o_orderstatus", "o_orderpriority"],
                              ["o_orderpriority", "o_orderkey", "o_orderstatus"], ["o_orderstatus", "o_orderkey"])):
        (o.filter(F.col("o_orderkey") % 3 == k).coalesce(1).sortWithinPartitions("o_orderkey").select(*cols)
         .write.option("header", True).csv(f"{path}/part={k}"))
    from ..sources.control import with_row_number
    return with_row_number(read_csv_text(spark, f"{path}/*", keep_place=True)).select(
        "o_orderkey", "o_orderstatus", "o_orderpriority", "row_num")


@query("sorted_positions", ("O1",), sql="""
SELECT o_orderkey, row_number() OVER (ORDER BY o_orderpriority, o_totalprice DESC, o_orderkey) AS position FROM orders
""")
def sorted_positions_q(spark: SparkSession, sf: str) -> DataFrame:
    """The place of every order in a global order, from a range partition and
    one offset per part."""
    o = table(spark, sf, "orders").select("o_orderkey", "o_orderpriority", "o_totalprice")
    by = [F.col("o_orderpriority"), F.col("o_totalprice").desc(), F.col("o_orderkey")]
    return sorted_positions(o, by).select("o_orderkey", "position")


@query("parquet_row_numbers", ("W1",), sql="""
SELECT o_orderkey, o_totalprice, row_number() OVER (ORDER BY o_orderkey) AS row_num FROM orders
""")
def parquet_row_numbers(spark: SparkSession, sf: str) -> DataFrame:
    """Rows of a Parquet table in several files, numbered from the reader's row
    index and the files' row counts."""
    path = scratch_path(spark, "numbered")
    (table(spark, sf, "orders").select("o_orderkey", "o_totalprice").repartitionByRange(6, "o_orderkey")
     .sortWithinPartitions("o_orderkey").write.parquet(path))
    return parquet_with_row_number(spark, path)


@query("catalog_diff", ("K5", "K4", "K3"), sql=_ORDERS_UPSERT_CTE + """
SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, 'order key' AS key_comment FROM merged
""")
def catalog_diff(spark: SparkSession, sf: str) -> DataFrame:
    """An external table over a bucketed lake table, registered, then brought up
    to date in place after an INC load; read through the catalog."""
    path = scratch_path(spark, "orders_catalog")
    name = "sluice_cat_" + path.rsplit("-", 1)[-1]
    base, batch = orders_base_and_batch(spark, sf)
    upsert(spark, base, path, ["o_orderkey"], ["ds_load_ts"], run_id="r1", num_buckets=4)
    register_table(spark, name, path)
    upsert(spark, batch, path, ["o_orderkey"], ["ds_load_ts"], run_id="r2")
    register_table(spark, name, path, {"o_orderkey": "order key"})
    comment = next(c.description for c in spark.catalog.listColumns(name) if c.name == "o_orderkey")
    return spark.table(name).select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice",
                                    F.lit(comment).alias("key_comment"))


@query("append_exactly_once", ("K2",), sql="""
SELECT o_orderkey, o_totalprice, CASE WHEN o_orderstatus = 'F' THEN 'r1' ELSE 'r2' END AS run_id FROM orders
""")
def append_exactly_once(spark: SparkSession, sf: str) -> DataFrame:
    """Two runs append to one table; the first is repeated. Every row is there once."""
    path = scratch_path(spark, "append_runs")
    o = table(spark, sf, "orders").select("o_orderkey", "o_totalprice", "o_orderstatus")
    for run, part in (("r1", F.col("o_orderstatus") == "F"), ("r2", F.col("o_orderstatus") != "F"),
                      ("r1", F.col("o_orderstatus") == "F")):
        lake.append_run(o.filter(part).drop("o_orderstatus"), path, run)
    return spark.read.parquet(path)


@query("elements_in_table", ("F3", "X1", "X4"), sql="""
WITH known AS (SELECT DISTINCT split_part(p_name, ' ', 2) AS w FROM part WHERE p_size > 40),
e AS (SELECT o_orderkey, i, trim(split_part(v, ',', i::INT)) AS w FROM (
  SELECT o_orderkey, p1.p_name || ' ,' || p2.p_name AS a, replace(p1.p_name, ' ', ', ') || ',' || p2.p_type AS v
  FROM orders JOIN part p1 ON p1.p_partkey = 1 + o_orderkey % (SELECT count(*) FROM part)
  JOIN part p2 ON p2.p_partkey = 1 + o_custkey % (SELECT count(*) FROM part)), range(1, 4) r(i))
SELECT o_orderkey AS row_id, string_agg(w, ', ' ORDER BY i) AS offending FROM e
WHERE w NOT IN (SELECT w FROM known) GROUP BY o_orderkey
""")
def elements_in_table(spark: SparkSession, sf: str) -> DataFrame:
    """Lists of three words per order, checked element by element against a
    column of ``part`` instead of a literal list."""
    p = table(spark, sf, "part")
    n = F.lit(p.count())
    one = p.select(F.col("p_partkey").alias("k1"), F.col("p_name").alias("n1"))
    two = p.select(F.col("p_partkey").alias("k2"), F.col("p_type").alias("t2"))
    o = (table(spark, sf, "orders").select("o_orderkey", (F.col("o_orderkey") % n + 1).alias("k1"),
                                           (F.col("o_custkey") % n + 1).alias("k2"))
         .join(one, "k1").join(two, "k2"))
    lists = o.select("o_orderkey", F.concat(F.replace("n1", F.lit(" "), F.lit(", ")), F.lit(","), "t2").alias("list"))
    known = p.filter(F.col("p_size") > 40).select(F.split("p_name", " ")[1].alias("w"))
    return Q.elements_not_in(lists, "o_orderkey", "list", known, "w")


@query("observed_quality", ("V4", "V3"), sql=_ORDER_FINDINGS_SQL + """
SELECT count(*) AS rows_seen, count(*) FILTER (WHERE o_orderkey IN (SELECT row_id FROM f)) AS rows_bad FROM orders
""")
def observed_quality(spark: SparkSession, sf: str) -> DataFrame:
    """Rows seen and rows bad, observed while the split is written; the metrics
    come from the write itself, not from another pass."""
    o = table(spark, sf, "orders").select("o_orderkey", "o_orderstatus", "o_orderpriority")
    flagged, obs = Q.observe_quality(Q.flag(o, ORDER_RULES))
    Q.write_split(flagged, scratch_path(spark, "observed"))
    return spark.createDataFrame([(int(obs.get["rows_seen"]), int(obs.get["rows_bad"]))], "rows_seen long, rows_bad long")


@query("paths_and_tags", ("P6", "P7", "P3", "X1"), sql="""
WITH items AS (
  SELECT p_partkey, trim(banner) AS banner, 'dl_' || lower(p_type) AS schema, lower(p_type) AS tbl, pos
  FROM (SELECT p_partkey, p_type, unnest(string_split(p_name, ' ')) AS banner,
               unnest(range(len(string_split(p_name, ' ')))) AS pos FROM part)),
named AS (SELECT *, lower(banner) || '_' || tbl AS table_name FROM items)
SELECT p_partkey AS row_id, CAST(pos AS INTEGER) AS pos, 'output/' || schema || '/' || table_name AS output_dir,
       'gs://id-' || p_partkey || '/' || table_name AS lake_path,
       'Ephemeral|SLT|' || banner || '|' || table_name AS tags
FROM named
""")
def paths_and_tags(spark: SparkSession, sf: str) -> DataFrame:
    """Output folder, lake path and tags of every work item."""
    from . import flow
    from ..functions import names as N
    items = flow.work_items(part_control_table(spark, sf))
    return items.select("row_id", "pos", "output_dir",
                        N.lake_path(F.concat(F.lit("id-"), F.col("row_id").cast("string")), "table_name").alias("lake_path"),
                        F.array_join("tags", "|").alias("tags"))


@query("blank_keys", ("F6", "J1", "C1"), sql="""
WITH k AS (SELECT o_orderkey, CASE o_orderkey % 4 WHEN 0 THEN NULL WHEN 1 THEN ' ' || chr(9) || chr(160)
             WHEN 2 THEN 'Customer#none' ELSE 'Customer-' || o_custkey END AS k FROM orders),
c AS (SELECT 'Customer-' || c_custkey AS c_key, c_mktsegment FROM customer)
SELECT o_orderkey, c_mktsegment, CASE WHEN c_key IS NOT NULL THEN 'ok' ELSE 'error' END AS status,
       CASE WHEN k IS NULL OR trim(k, ' ' || chr(9) || chr(160)) = '' THEN 'no_key'
            WHEN c_key IS NULL THEN 'not_found' END AS error_class
FROM k LEFT JOIN c ON k.k = c.c_key
""")
def blank_keys(spark: SparkSession, sf: str) -> DataFrame:
    """Orders looked up by a key that is missing, blank, unknown or good: a
    missing or blank key is an outcome of its own and never enters the join."""
    m = F.col("o_orderkey") % 4
    key = (F.when(m == 1, " \t ").when(m == 2, "Customer#none")
           .when(m == 3, F.concat(F.lit("Customer-"), F.col("o_custkey").cast("string"))))
    o = table(spark, sf, "orders").select("o_orderkey", key.alias("k"))
    usable = key_guard("k")
    guarded = o.withColumn("good", F.when(usable, F.col("k")))
    c = table(spark, sf, "customer").select(F.concat(F.lit("Customer-"), F.col("c_custkey").cast("string")).alias("c_key"),
                                            "c_mktsegment")
    j = lookup(guarded, c, "good", "c_key", order=["c_mktsegment"], values=["c_mktsegment"], hit_col="_hit")
    return with_outcome(j, [
        (~usable, "no_key", F.lit("no lookup key")),
        (~F.col("_hit"), "not_found", F.lit("key not found")),
    ]).select("o_orderkey", "c_mktsegment", "status", "error_class")


@query("zipped_lists", ("J4", "X1"), sql="""
WITH l AS (SELECT p_partkey, string_split(p_name, ' ') AS a, string_split(p_brand || '#' || p_type, '#') AS b FROM part),
n AS (SELECT *, greatest(len(a), len(b)) AS n FROM l)
SELECT p_partkey, CAST(i AS INTEGER) AS pos, a[i + 1] AS word, b[i + 1] AS mark FROM n, range(0, 3) r(i) WHERE i < n
""")
def zipped_lists(spark: SparkSession, sf: str) -> DataFrame:
    """Two lists per row joined by position; the shorter one is filled with NULL."""
    from ..operators.explode import zip_lists
    p = table(spark, sf, "part").select(
        "p_partkey", F.split("p_name", " ").alias("word"),
        F.split(F.concat("p_brand", F.lit("#"), "p_type"), "#").alias("mark"))
    z = p.select("p_partkey", F.posexplode(zip_lists("word", "mark")).alias("pos", "z"))
    return z.select("p_partkey", "pos", F.col("z.word").alias("word"), F.col("z.mark").alias("mark"))


@query("guarded_sources", ("S2", "S3", "U2"), sql="""
SELECT 'orders' AS source, 'ok' AS status, '' AS missing, (SELECT count(*) FROM orders) AS "rows"
UNION ALL SELECT 'customer', 'missing_columns', 'o_custkey,o_orderkey', (SELECT count(*) FROM customer)
UNION ALL SELECT 'late_orders', 'empty', '', 0
""")
def guarded_sources(spark: SparkSession, sf: str) -> DataFrame:
    """Sources checked before they are used: one is good, one lacks required
    columns, one has no row. Each is an outcome."""
    from ..operators.setops import missing_columns
    o = table(spark, sf, "orders")
    sources = {"orders": o, "customer": table(spark, sf, "customer"),
               "late_orders": o.filter(F.col("o_orderdate") > ts_ntz("2999-01-01"))}
    required = ["o_orderkey", "o_custkey"]
    out = []
    for name, df in sources.items():
        status = "ok"
        try:
            Q.require_columns(df, required)
            status = "empty"
            Q.require_rows(df, name)
            status = "ok"
        except Q.ValidationError:
            status = "missing_columns" if status == "ok" else status
        out.append((name, status, ",".join(sorted(missing_columns(df, required))), df.count()))
    return spark.createDataFrame(out, "source string, status string, missing string, rows long")
