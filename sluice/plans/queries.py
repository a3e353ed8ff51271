"""Registered queries over the driver's test tables.

Every query reads whole tables (no key subsets, no row caps; ``topk_preview``
keeps a LIMIT because the preview is the feature). Increments for the upsert
queries are date-range slices, the way a daily change feed arrives.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import names as N
from ..functions.codes import lower_or_default, map_code, refresh_label
from ..operators import quality as Q
from ..operators.dedup import first_per_key, latest_per_key
from ..operators.explode import explode_list, per_row_list
from ..operators.lookup import lookup, lookup_misses
from ..operators.outcomes import run_summary, with_outcome
from ..operators.setops import union_by_name
from ..operators.topk import preview
from ..sinks.upsert import merge_latest
from ..sources.tables import table, ts_ntz
from .registry import query

# ---------------------------------------------------------------------------
# K4 / A3 — upsert, newest precombine value wins
# ---------------------------------------------------------------------------

ORDER_COLS = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate",
              "o_orderpriority"]


def orders_base_and_batch(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    """Base = orders loaded before 1999; batch = the change feed from 1998 on.

    In the batch every price changed (+1.0); its precombine value is one day
    newer for open orders, one day older for finished ones (stale replay) and
    equal for pending ones (tie: the batch wins).
    """
    o = table(spark, sf, "orders")
    base = (o.filter(F.col("o_orderdate") < ts_ntz("1999-01-01"))
            .withColumn("ds_load_ts", F.col("o_orderdate")))
    shift = (F.when(F.col("o_orderstatus") == "O", F.expr("INTERVAL 1 DAY"))
             .when(F.col("o_orderstatus") == "F", F.expr("INTERVAL -1 DAY"))
             .otherwise(F.expr("INTERVAL 0 DAY")))
    batch = (o.filter(F.col("o_orderdate") >= ts_ntz("1998-01-01"))
             .withColumn("o_totalprice", F.col("o_totalprice") + F.lit(1.0))
             .withColumn("ds_load_ts", F.col("o_orderdate") + shift))
    return base, batch


_ORDERS_UPSERT_CTE = """
WITH base AS (
  SELECT *, o_orderdate AS ds_load_ts, 0 AS src FROM orders
  WHERE o_orderdate < TIMESTAMP '1999-01-01'),
batch AS (
  SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice + 1.0 AS o_totalprice,
         o_orderdate, o_orderpriority,
         CASE o_orderstatus WHEN 'O' THEN o_orderdate + INTERVAL 1 DAY
                            WHEN 'F' THEN o_orderdate - INTERVAL 1 DAY
                            ELSE o_orderdate END AS ds_load_ts,
         1 AS src
  FROM orders WHERE o_orderdate >= TIMESTAMP '1998-01-01'),
merged AS (
  SELECT * FROM (SELECT * FROM base UNION ALL BY NAME SELECT * FROM batch)
  QUALIFY row_number() OVER (PARTITION BY o_orderkey
                             ORDER BY ds_load_ts DESC NULLS LAST, src DESC) = 1)
"""


@query("upsert_latest", ("K4", "A3", "U1"), sql=_ORDERS_UPSERT_CTE + """
SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority,
       ds_load_ts
FROM merged
""")
def upsert_latest(spark: SparkSession, sf: str) -> DataFrame:
    base, batch = orders_base_and_batch(spark, sf)
    return merge_latest(base, batch, ["o_orderkey"], ["ds_load_ts"])


@query("upsert_composite_key", ("K4", "A3"), sql="""
WITH base AS (
  SELECT *, l_shipdate AS ds_load_ts, 0 AS src FROM lineitem),
batch AS (
  SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity + 1.0 AS l_quantity,
         l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus, l_shipdate,
         CASE l_returnflag WHEN 'R' THEN l_shipdate + INTERVAL 1 DAY
                           WHEN 'A' THEN l_shipdate - INTERVAL 1 DAY
                           ELSE l_shipdate END AS ds_load_ts,
         1 AS src
  FROM lineitem WHERE l_shipdate >= TIMESTAMP '2000-01-01')
SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice,
       l_discount, l_tax, l_returnflag, l_linestatus, l_shipdate, ds_load_ts
FROM (SELECT * FROM base UNION ALL BY NAME SELECT * FROM batch)
QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber
                           ORDER BY ds_load_ts DESC NULLS LAST, src DESC,
                                    l_partkey DESC, l_suppkey DESC, l_quantity DESC) = 1
""")
def upsert_composite_key(spark: SparkSession, sf: str) -> DataFrame:
    """Key (l_orderkey, l_linenumber) is not unique inside one load: the
    explicit tie-break (part, supplier, quantity) makes the survivor defined."""
    li = table(spark, sf, "lineitem")
    base = li.withColumn("ds_load_ts", F.col("l_shipdate"))
    shift = (F.when(F.col("l_returnflag") == "R", F.expr("INTERVAL 1 DAY"))
             .when(F.col("l_returnflag") == "A", F.expr("INTERVAL -1 DAY"))
             .otherwise(F.expr("INTERVAL 0 DAY")))
    batch = (li.filter(F.col("l_shipdate") >= ts_ntz("2000-01-01"))
             .withColumn("l_quantity", F.col("l_quantity") + F.lit(1.0))
             .withColumn("ds_load_ts", F.col("l_shipdate") + shift))
    return merge_latest(base, batch, ["l_orderkey", "l_linenumber"], ["ds_load_ts"],
                        tiebreak=["l_partkey", "l_suppkey", "l_quantity"])


# ---------------------------------------------------------------------------
# A1 / P1 / X2 — keyed dedup, first in order
# ---------------------------------------------------------------------------

@query("dedup_first_code", ("A1", "X2"), sql="""
SELECT lower(o_orderpriority) AS code, o_orderkey, o_orderdate
FROM orders
QUALIFY row_number() OVER (PARTITION BY lower(o_orderpriority) ORDER BY o_orderkey) = 1
""")
def dedup_first_code(spark: SparkSession, sf: str) -> DataFrame:
    o = table(spark, sf, "orders").select(
        F.lower("o_orderpriority").alias("code"), "o_orderkey", "o_orderdate")
    # Few distinct keys: aggregate form (partial min_by per task, tiny shuffle).
    return first_per_key(o, ["code"], ["o_orderkey"], strategy="agg")


@query("dedup_first_customer", ("A1", "P1"), sql="""
SELECT o_custkey AS customer, o_orderkey AS first_order, o_orderdate AS first_date
FROM orders
QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) = 1
""")
def dedup_first_customer(spark: SparkSession, sf: str) -> DataFrame:
    o = table(spark, sf, "orders").select(
        F.col("o_custkey").alias("customer"), F.col("o_orderkey").alias("first_order"),
        F.col("o_orderdate").alias("first_date"))
    return first_per_key(o, ["customer"], ["first_order"])


# ---------------------------------------------------------------------------
# X1 / X3 / A4 — fan-out and per-row lists
# ---------------------------------------------------------------------------

@query("explode_list", ("X1", "X3", "X4"), sql="""
SELECT p_partkey, CAST(pos AS INTEGER) AS pos, upper(trim(word)) AS word
FROM (SELECT p_partkey, unnest(string_split(p_name, ' ')) AS word,
             unnest(range(len(string_split(p_name, ' ')))) AS pos
      FROM part)
""")
def explode_list_q(spark: SparkSession, sf: str) -> DataFrame:
    p = table(spark, sf, "part").select("p_partkey", "p_name")
    e = explode_list(p, "p_name", sep=" ", value_col="word", pos_col="pos")
    return e.select("p_partkey", "pos", F.upper("word").alias("word"))


@query("row_array", ("A4", "X1", "X2"), sql="""
SELECT p_partkey,
       list_transform(string_split(p_name, ' '),
                      lambda x: lower(trim(x)) || '_' || lower(p_brand)) AS names
FROM part
""")
def row_array(spark: SparkSession, sf: str) -> DataFrame:
    p = table(spark, sf, "part")
    names = per_row_list("p_name", lambda x: F.concat(F.lower(x), F.lit("_"), F.lower("p_brand")),
                         sep=" ")
    return p.select("p_partkey", names.alias("names"))


# ---------------------------------------------------------------------------
# P3-P8 — names
# ---------------------------------------------------------------------------

@query("derive_names", ("P3", "P4", "P5", "X5", "X6"), sql="""
SELECT c_custkey,
       lower(trim(c_mktsegment)) || '_' || lower(c_name) AS table_name,
       replace(lower('dl_' || lower(c_mktsegment) || '_raw'), '_', '-') || '-' ||
         lower(trim(c_mktsegment)) || '-' || replace(lower(c_name), '_', '-') AS cluster_name,
       'INTLDLDAT-SA' || c_mktsegment || '-' ||
         CASE WHEN c_acctbal >= 0 THEN 'INC' ELSE 'FULL' END || '-' ||
         upper('dl_' || lower(c_mktsegment) || '_raw') || '-' || c_mktsegment || '_' || c_name
         AS unit_name
FROM customer
""")
def derive_names(spark: SparkSession, sf: str) -> DataFrame:
    c = table(spark, sf, "customer")
    schema = F.concat(F.lit("dl_"), F.lower("c_mktsegment"), F.lit("_raw"))
    load = F.when(F.col("c_acctbal") >= 0, F.lit("INC")).otherwise(F.lit("FULL"))
    return c.select(
        "c_custkey",
        N.table_name("c_mktsegment", "c_name").alias("table_name"),
        N.cluster_name(schema, "c_mktsegment", "c_name").alias("cluster_name"),
        N.unit_name("c_mktsegment", load, schema, "c_name").alias("unit_name"),
    )


@query("decode_name", ("P5", "P8", "X7", "X8", "X10"), sql="""
WITH u AS (
  SELECT o_orderkey,
         'INTLDLDAT-SA' || o_orderstatus || '-' ||
           CASE WHEN o_totalprice > 250000 THEN 'INC' ELSE 'FULL' END || '-' ||
           'DL_ORDERS' || '-' || o_orderstatus || '_' ||
           CASE WHEN o_orderstatus = 'P' THEN o_orderpriority
                ELSE substr(o_orderpriority, 3) END AS unit
  FROM orders),
p AS (SELECT o_orderkey, unit, string_split(unit, '-') AS parts FROM u),
d AS (
  SELECT o_orderkey, unit, parts,
         substr(parts[2], 3) AS banner,
         coalesce(len(parts) = 5 AND substr(parts[2], 1, 2) = 'SA'
                  AND starts_with(parts[5], substr(parts[2], 3) || '_'), false) AS ok
  FROM p)
SELECT o_orderkey, unit, ok,
       CASE WHEN ok THEN banner END AS banner,
       CASE WHEN ok THEN parts[3] END AS load_type,
       CASE WHEN ok THEN parts[4] END AS schema,
       CASE WHEN ok THEN substr(parts[5], length(banner) + 2) END AS "table"
FROM d
""")
def decode_name(spark: SparkSession, sf: str) -> DataFrame:
    """Encode (P5) then decode (P8). Pending orders put a ``-`` into the
    table part, which makes six parts: decode reports ``ok = false``."""
    o = table(spark, sf, "orders")
    load = F.when(F.col("o_totalprice") > 250000, F.lit("INC")).otherwise(F.lit("FULL"))
    tbl = F.when(F.col("o_orderstatus") == "P", F.col("o_orderpriority")).otherwise(
        F.substr(F.col("o_orderpriority"), F.lit(3)))
    u = o.select("o_orderkey", N.unit_name("o_orderstatus", load, F.lit("dl_orders"), tbl).alias("unit"))
    d = u.select("o_orderkey", "unit", N.decode_unit_name("unit").alias("d"))
    return d.select("o_orderkey", "unit", "d.ok", "d.banner", "d.load_type", "d.schema", "d.table")


# ---------------------------------------------------------------------------
# P9-P11 — code maps and labels
# ---------------------------------------------------------------------------

STATUS_LABELS = {"F": "closed", "O": "open"}


@query("code_map_default", ("P9", "P10", "P11"), sql="""
SELECT o_orderkey,
       CASE o_orderstatus WHEN 'F' THEN 'closed' WHEN 'O' THEN 'open' ELSE 'unknown' END
         AS status_label,
       CASE WHEN lower(CASE WHEN o_totalprice > 100000 THEN 'INC' ELSE 'FULL' END) = 'inc'
            THEN 'incremental load'
            ELSE lower(CASE WHEN o_totalprice > 100000 THEN 'INC' ELSE 'FULL' END) || ' load'
       END AS refresh_mode
FROM orders
""")
def code_map_default(spark: SparkSession, sf: str) -> DataFrame:
    o = table(spark, sf, "orders")
    load = F.when(F.col("o_totalprice") > 100000, F.lit("INC")).otherwise(F.lit("FULL"))
    return o.select(
        "o_orderkey",
        map_code("o_orderstatus", STATUS_LABELS, "unknown").alias("status_label"),
        refresh_label(lower_or_default(load, "incremental")).alias("refresh_mode"),
    )


# ---------------------------------------------------------------------------
# V1-V3, F2-F5 — validation
# ---------------------------------------------------------------------------

ORDER_RULES = (
    Q.Rule("priority_present", "o_orderpriority", "not_blank",
           message="o_orderpriority is empty"),
    Q.Rule("priority_parts", "o_orderpriority", "each_in", sep="-",
           allowed=("1", "2", "3", "4", "5", "URGENT", "HIGH", "MEDIUM", "LOW"),
           message="Invalid priority part(s)"),
    Q.Rule("status_ci", "o_orderstatus", "in_ci", allowed=("f", "o"),
           message="Invalid o_orderstatus; must be one of: f, o"),
    Q.Rule("segment_upper", "o_orderpriority", "in_upper",
           allowed=("1-URGENT", "2-HIGH", "3-MEDIUM", "5-LOW"),
           message="Invalid o_orderpriority"),
)

_ORDER_FINDINGS_SQL = """
WITH f AS (
  SELECT o_orderkey AS row_id, 0 AS rule_pos, 'priority_present' AS rule_id,
         'o_orderpriority' AS "column", CAST(NULL AS VARCHAR) AS offending,
         'o_orderpriority is empty' AS message
  FROM orders WHERE o_orderpriority IS NULL OR trim(o_orderpriority) = ''
  UNION ALL
  SELECT o_orderkey, 1, 'priority_parts', 'o_orderpriority',
         array_to_string(list_filter(list_transform(string_split(o_orderpriority, '-'),
                                                    lambda x: trim(x)),
                         lambda x: NOT list_contains(['1','2','3','4','5','URGENT','HIGH',
                                                      'MEDIUM','LOW'], x)), ', '),
         'Invalid priority part(s)'
  FROM orders
  WHERE o_orderpriority IS NULL
     OR len(list_filter(list_transform(string_split(o_orderpriority, '-'), lambda x: trim(x)),
                        lambda x: NOT list_contains(['1','2','3','4','5','URGENT','HIGH',
                                                     'MEDIUM','LOW'], x))) > 0
  UNION ALL
  SELECT o_orderkey, 2, 'status_ci', 'o_orderstatus', o_orderstatus,
         'Invalid o_orderstatus; must be one of: f, o'
  FROM orders WHERE coalesce(lower(o_orderstatus) NOT IN ('f', 'o'), true)
  UNION ALL
  SELECT o_orderkey, 3, 'segment_upper', 'o_orderpriority', o_orderpriority,
         'Invalid o_orderpriority'
  FROM orders
  WHERE coalesce(upper(o_orderpriority) NOT IN ('1-URGENT', '2-HIGH', '3-MEDIUM', '5-LOW'), true))
"""


@query("row_violations", ("V1", "F2", "F3", "F4", "F5"), sql=_ORDER_FINDINGS_SQL + """
SELECT row_id, CAST(rule_pos AS INTEGER) AS rule_pos, rule_id, "column", offending, message
FROM f
""")
def row_violations(spark: SparkSession, sf: str) -> DataFrame:
    o = table(spark, sf, "orders")
    return Q.violations(o, ORDER_RULES, "o_orderkey")


@query("quarantine_split", ("V3",), sql=_ORDER_FINDINGS_SQL + """
, agg AS (SELECT row_id, count(*) AS n, min(rule_pos) AS first_pos FROM f GROUP BY row_id)
SELECT o.o_orderkey, CASE WHEN a.n IS NULL THEN 'valid' ELSE 'rejected' END AS quality,
       CAST(coalesce(a.n, 0) AS INTEGER) AS n_findings,
       CASE a.first_pos WHEN 0 THEN 'priority_present' WHEN 1 THEN 'priority_parts'
                        WHEN 2 THEN 'status_ci' WHEN 3 THEN 'segment_upper' END AS first_rule
FROM orders o LEFT JOIN agg a ON a.row_id = o.o_orderkey
""")
def quarantine_split(spark: SparkSession, sf: str) -> DataFrame:
    o = table(spark, sf, "orders").select("o_orderkey", "o_orderstatus", "o_orderpriority")
    flagged = Q.flag(o, ORDER_RULES)  # one scan, one projection
    bad = F.size(Q.FINDINGS) > 0
    return flagged.select("o_orderkey", F.when(bad, "rejected").otherwise("valid").alias("quality"),
                          F.size(Q.FINDINGS).alias("n_findings"),
                          F.try_element_at(F.col(Q.FINDINGS), F.lit(1))["rule_id"].alias("first_rule"))


# ---------------------------------------------------------------------------
# J1 / J2 / F6 / C1 — lookups and item outcomes
# ---------------------------------------------------------------------------

@query("lookup_left", ("J1", "A1", "O3"), sql="""
SELECT d.doc_id, d.lang, d.source, l.quality, l.toxic
FROM documents d
LEFT JOIN (SELECT * FROM labels
           QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY quality, toxic) = 1) l
  ON d.doc_id = l.doc_id
""")
def lookup_left(spark: SparkSession, sf: str) -> DataFrame:
    d = table(spark, sf, "documents").select("doc_id", "lang", "source")
    lab = table(spark, sf, "labels")
    return lookup(d, lab, "doc_id", "doc_id", order=["quality", "toxic"],
                  values=["quality", "toxic"])


@query("lookup_miss", ("J2",), sql="""
SELECT d.doc_id, d.source,
       'doc_id ' || CAST(d.doc_id AS VARCHAR) || ' not found in labels' AS error
FROM documents d
WHERE NOT EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id)
""")
def lookup_miss(spark: SparkSession, sf: str) -> DataFrame:
    d = table(spark, sf, "documents").select("doc_id", "source")
    miss = lookup_misses(d, table(spark, sf, "labels"), "doc_id", "doc_id")
    return miss.select("doc_id", "source", F.concat(
        F.lit("doc_id "), F.col("doc_id").cast("string"), F.lit(" not found in labels")).alias("error"))


@query("item_outcomes", ("C1", "J1", "J2", "F6"), sql="""
SELECT d.doc_id, l.quality,
       CASE WHEN d.source IS NULL OR trim(d.source) = '' THEN 'error'
            WHEN l.doc_id IS NULL THEN 'error' ELSE 'ok' END AS status,
       CASE WHEN d.source IS NULL OR trim(d.source) = '' THEN 'missing_key'
            WHEN l.doc_id IS NULL THEN 'not_found' END AS error_class,
       CASE WHEN d.source IS NULL OR trim(d.source) = '' THEN 'source is empty'
            WHEN l.doc_id IS NULL
            THEN 'doc ' || CAST(d.doc_id AS VARCHAR) || ' not found in labels' END AS error
FROM documents d
LEFT JOIN (SELECT * FROM labels
           QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY quality, toxic) = 1) l
  ON d.doc_id = l.doc_id
""")
def item_outcomes(spark: SparkSession, sf: str) -> DataFrame:
    from ..operators.lookup import key_guard
    d = table(spark, sf, "documents").select("doc_id", "source")
    j = lookup(d, table(spark, sf, "labels"), "doc_id", "doc_id", order=["quality", "toxic"],
               values=["quality"], hit_col="_hit")
    out = with_outcome(j, [
        (~key_guard("source"), "missing_key", F.lit("source is empty")),
        (~F.col("_hit"), "not_found",
         F.concat(F.lit("doc "), F.col("doc_id").cast("string"), F.lit(" not found in labels"))),
    ])
    return out.select("doc_id", "quality", "status", "error_class", "error")


@query("run_summary", ("C2", "A2"), sql="""
SELECT status, error_class, count(*) AS items
FROM (SELECT CASE WHEN o_orderstatus = 'P' THEN 'error'
                  WHEN o_totalprice > 450000 THEN 'error' ELSE 'ok' END AS status,
             CASE WHEN o_orderstatus = 'P' THEN 'pending'
                  WHEN o_totalprice > 450000 THEN 'over_limit' END AS error_class
      FROM orders)
GROUP BY status, error_class
""")
def run_summary_q(spark: SparkSession, sf: str) -> DataFrame:
    o = table(spark, sf, "orders")
    items = with_outcome(o, [
        (F.col("o_orderstatus") == "P", "pending", F.lit("order is pending")),
        (F.col("o_totalprice") > 450000, "over_limit", F.lit("price over limit")),
    ])
    return run_summary(items)


# ---------------------------------------------------------------------------
# O1 / O2 — ordering
# ---------------------------------------------------------------------------

@query("topk_preview", ("O2",), sql="""
SELECT o_orderkey, o_totalprice, o_orderdate FROM orders
ORDER BY o_totalprice DESC, o_orderkey LIMIT 5
""")
def topk_preview(spark: SparkSession, sf: str) -> DataFrame:
    o = table(spark, sf, "orders").select("o_orderkey", "o_totalprice", "o_orderdate")
    return preview(o, [F.col("o_totalprice").desc(), "o_orderkey"], 5)


# ---------------------------------------------------------------------------
# U1 / J3 — union by name, insert-if-absent
# ---------------------------------------------------------------------------

@query("append_by_name", ("U1",), sql="""
SELECT o_orderkey, o_custkey, o_orderstatus FROM orders WHERE o_orderstatus = 'F'
UNION ALL BY NAME
SELECT o_orderkey, o_totalprice, o_orderpriority FROM orders WHERE o_orderstatus <> 'F'
""")
def append_by_name(spark: SparkSession, sf: str) -> DataFrame:
    o = table(spark, sf, "orders")
    return union_by_name([
        o.filter(F.col("o_orderstatus") == "F").select("o_orderkey", "o_custkey", "o_orderstatus"),
        o.filter(F.col("o_orderstatus") != "F").select("o_orderkey", "o_totalprice", "o_orderpriority"),
    ])


@query("insert_if_absent", ("J3", "A1"), sql="""
WITH existing AS (SELECT c_custkey, c_name, c_mktsegment FROM customer WHERE c_acctbal >= 0),
incoming AS (
  SELECT c_custkey, c_name, c_mktsegment, 0 AS seq FROM customer
  UNION ALL
  SELECT c_custkey, c_name, c_mktsegment, 1 AS seq FROM customer WHERE c_mktsegment = 'BUILDING'),
fresh AS (
  SELECT c_custkey, c_name, c_mktsegment FROM incoming
  QUALIFY row_number() OVER (PARTITION BY c_custkey ORDER BY seq) = 1)
SELECT c_custkey, c_name, c_mktsegment, 'existing' AS origin FROM existing
UNION ALL
SELECT f.c_custkey, f.c_name, f.c_mktsegment, 'new' AS origin FROM fresh f
WHERE NOT EXISTS (SELECT 1 FROM existing e WHERE e.c_custkey = f.c_custkey)
""")
def insert_if_absent_q(spark: SparkSession, sf: str) -> DataFrame:
    """Requests re-submitted (some twice in one run) only add keys not yet present."""
    from ..operators.lookup import insert_if_absent
    c = table(spark, sf, "customer")
    existing = c.filter(F.col("c_acctbal") >= 0).select("c_custkey", "c_name", "c_mktsegment")
    incoming = union_by_name([
        c.select("c_custkey", "c_name", "c_mktsegment", F.lit(0).alias("seq")),
        c.filter(F.col("c_mktsegment") == "BUILDING")
         .select("c_custkey", "c_name", "c_mktsegment", F.lit(1).alias("seq")),
    ])
    new = insert_if_absent(existing, incoming, ["c_custkey"], ["seq"]).drop("seq")
    return union_by_name([existing.withColumn("origin", F.lit("existing")),
                          new.withColumn("origin", F.lit("new"))])


# ---------------------------------------------------------------------------
# End-to-end control flow: items -> names -> storage lookup -> outcomes
# ---------------------------------------------------------------------------

def control_items(spark: SparkSession, sf: str) -> DataFrame:
    """The flow's own fan-out, naming, mapping and lookup. Control rows = parts
    of size <= 40 (the name's words are the banner list, the type is the
    table); the portal export = parts of size > 40 (first word + type as the
    mixed-case table name, an id per part), first row of a name winning."""
    from . import flow
    p = table(spark, sf, "part")
    control = part_control_table(spark, sf).join(p.filter(F.col("p_size") <= 40).select("p_partkey"),
                                                 F.col("row_id") == F.col("p_partkey"), "left_semi")
    export = p.filter(F.col("p_size") > 40).select(
        F.concat(F.upper(F.split("p_name", " ")[0]), F.lit("_"), F.col("p_type")).alias("tableName"),
        F.concat(F.lit("bkt"), F.col("p_partkey").cast("string")).alias("bucket_name"))
    items = flow.resolve_items(flow.work_items(control), flow.storage_mapping(export, by_schema=False))
    return items.select(F.col("row_id").alias("p_partkey"), "pos", "banner", "table_name", "bucket_id", "status",
                        "error_class", "error")


_CONTROL_ITEMS_SQL = """
WITH control AS (SELECT p_partkey, p_name AS banners, p_type AS tbl FROM part WHERE p_size <= 40),
mapping AS (
  SELECT lower(upper(split_part(p_name, ' ', 1)) || '_' || p_type) AS dlTableName,
         'bkt' || CAST(p_partkey AS VARCHAR) AS bucket_name, p_partkey AS seq
  FROM part WHERE p_size > 40),
m1 AS (SELECT * FROM mapping
       QUALIFY row_number() OVER (PARTITION BY dlTableName ORDER BY seq) = 1),
items AS (
  SELECT p_partkey, tbl, CAST(pos AS INTEGER) AS pos, trim(banner) AS banner
  FROM (SELECT p_partkey, tbl, unnest(string_split(banners, ' ')) AS banner,
               unnest(range(len(string_split(banners, ' ')))) AS pos FROM control)),
named AS (SELECT *, lower(trim(banner)) || '_' || lower(tbl) AS table_name FROM items),
j AS (SELECT n.*, m1.bucket_name, m1.dlTableName IS NOT NULL AS hit
      FROM named n LEFT JOIN m1 ON n.table_name = m1.dlTableName)
SELECT p_partkey, pos, banner, table_name, bucket_name AS bucket_id,
       CASE WHEN table_name IS NULL OR NOT hit THEN 'error' ELSE 'ok' END AS status,
       CASE WHEN table_name IS NULL THEN 'bad_name' WHEN NOT hit THEN 'not_found' END
         AS error_class,
       CASE WHEN table_name IS NULL THEN 'table name could not be derived'
            WHEN NOT hit THEN 'Table ''' || table_name || ''' not found in mapping' END AS error
FROM j
"""


query("control_items", ("X1", "P3", "A1", "J1", "J2", "C1"), sql=_CONTROL_ITEMS_SQL)(control_items)


@query("control_flow", ("X1", "P3", "A1", "J1", "C1", "C2"), sql="""
WITH items AS (""" + _CONTROL_ITEMS_SQL + """)
SELECT status, error_class, count(*) AS items FROM items GROUP BY status, error_class
""")
def control_flow(spark: SparkSession, sf: str) -> DataFrame:
    return run_summary(control_items(spark, sf))


@query("latest_lineitem", ("A3",), sql="""
SELECT * FROM lineitem
QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber
                           ORDER BY l_shipdate DESC NULLS LAST, l_partkey DESC,
                                    l_suppkey DESC, l_quantity DESC, l_extendedprice DESC,
                                    l_discount DESC, l_tax DESC, l_returnflag DESC,
                                    l_linestatus DESC) = 1
""")
def latest_lineitem(spark: SparkSession, sf: str) -> DataFrame:
    """A3 on a near-unique composite key over the whole fact table."""
    li = table(spark, sf, "lineitem")
    return latest_per_key(li, ["l_orderkey", "l_linenumber"], ["l_shipdate"])


@query("first_per_supplier", ("A1",), sql="""
SELECT * FROM lineitem
QUALIFY row_number() OVER (PARTITION BY l_suppkey
                           ORDER BY l_shipdate NULLS LAST, l_orderkey, l_partkey,
                                    l_linenumber, l_quantity, l_extendedprice, l_discount,
                                    l_tax, l_returnflag, l_linestatus) = 1
""")
def first_per_supplier(spark: SparkSession, sf: str) -> DataFrame:
    """A1 on few keys (one per supplier): aggregate form, partial per task."""
    li = table(spark, sf, "lineitem")
    return first_per_key(li, ["l_suppkey"], ["l_shipdate"], strategy="agg")


@query("quality_counts", ("A2",), sql=_ORDER_FINDINGS_SQL + """
SELECT count(*) AS "rows",
       count(*) FILTER (WHERE o_orderkey IN (SELECT row_id FROM f)) AS rows_bad,
       count(*) FILTER (WHERE o_orderstatus = 'P') AS pending
FROM orders
""")
def quality_counts(spark: SparkSession, sf: str) -> DataFrame:
    """Global counts in one pass: rows seen, rows with any finding, pending."""
    from ..operators.outcomes import counts
    o = Q.flag(table(spark, sf, "orders"), ORDER_RULES)
    return counts(o, rows_bad=F.size(Q.FINDINGS) > 0, pending=F.col("o_orderstatus") == "P")


@query("sorted_listing", ("O1", "P5"), sql="""
SELECT 'INTLDLDAT-SA' || c_mktsegment || '-INC-DL_CUSTOMERS-' || c_mktsegment || '_' || c_name
         AS unit_name
FROM customer ORDER BY unit_name
""")
def sorted_listing_q(spark: SparkSession, sf: str) -> DataFrame:
    """O1: all unit names in ascending lexical order (range-partitioned sort)."""
    from ..operators.topk import sorted_listing
    c = table(spark, sf, "customer")
    names = c.select(N.unit_name("c_mktsegment", F.lit("INC"), F.lit("dl_customers"), "c_name")
                     .alias("unit_name"))
    return sorted_listing(names, ["unit_name"])


# ---------------------------------------------------------------------------
# P2 / J3 through the flow's own functions
# ---------------------------------------------------------------------------

def part_control_table(spark: SparkSession, sf: str) -> DataFrame:
    """A control table shaped like the real one, derived from ``part``: the
    name's words are the banner list, the type is the table, the brand the
    source table; sensitivity and load type follow price and type."""
    p = table(spark, sf, "part")
    sens = (F.when(F.col("p_retailprice") > 1500, F.lit("HS"))
            .when(F.col("p_retailprice") > 1200, F.lit("se")).otherwise(F.lit("ns")))
    load = F.when(F.col("p_type").isin("PROMO", "SMALL"), F.lit("FULL")).otherwise(F.lit("inc"))
    return p.select(
        F.col("p_brand").alias("icdsTableName"),
        F.replace(F.col("p_name"), F.lit(" "), F.lit(",")).alias("BANNER_NAME"),
        sens.alias("dataSensitivity"),
        F.concat(F.lit("dl_"), F.lower("p_type")).alias("dlSchemaName"),
        F.col("p_type").alias("dlTableName"), load.alias("tableLoadType"),
        F.lit(None).cast("string").alias("keyPreCombine"),
        F.lit(None).cast("string").alias("keyPrimaryKey"),
        F.col("p_partkey").alias("row_id"))


@query("request_rows", ("P2", "P9", "P10", "P11"), sql="""
WITH control AS (
  SELECT p_partkey AS row_id, replace(p_name, ' ', ',') AS banners,
         lower(CASE WHEN p_retailprice > 1500 THEN 'HS' WHEN p_retailprice > 1200 THEN 'se'
                    ELSE 'ns' END) AS sensitivity,
         'dl_' || lower(p_type) AS schema, p_type AS tbl,
         upper(CASE WHEN p_type IN ('PROMO', 'SMALL') THEN 'FULL' ELSE 'inc' END) AS load_type
  FROM part),
items AS (
  SELECT row_id, schema, tbl, sensitivity, load_type, trim(banner) AS banner, pos
  FROM (SELECT *, unnest(string_split(banners, ',')) AS banner,
               unnest(range(len(string_split(banners, ',')))) AS pos FROM control)),
req AS (
  SELECT 'hash' AS bucketNameType, schema AS databaseName,
         lower(trim(banner)) || '_' || lower(tbl) AS tableName,
         'SA-' || upper(banner) AS opCmpnyCd,
         CASE WHEN lower(load_type) = 'inc' THEN 'incremental load'
              ELSE lower(load_type) || ' load' END AS refreshMode,
         CASE sensitivity WHEN 'se' THEN 'ns' WHEN 'ns' THEN 'ns' WHEN 'hs' THEN 'hs'
                          ELSE 'ns' END AS sfx,
         false AS isDevBigLake, 'DCA Logic' AS updateSoftDelete,
         CAST(NULL AS VARCHAR) AS resourceBucketType, row_id, pos
  FROM items)
SELECT bucketNameType, databaseName, tableName, opCmpnyCd, refreshMode,
       'svc-ingest-' || sfx || '@lake-' || sfx || '-dev.example' AS storage_uploader,
       'svc-ingest-' || sfx || '@lake-' || sfx || '-dev.example' AS storage_viewer,
       isDevBigLake, updateSoftDelete, resourceBucketType
FROM req
QUALIFY row_number() OVER (PARTITION BY databaseName, tableName ORDER BY row_id, pos) = 1
""")
def request_rows(spark: SparkSession, sf: str) -> DataFrame:
    """One storage request per distinct (schema, table name) the control
    table asks for; the first asking item (row, then banner order) wins."""
    from . import flow
    items = flow.work_items(part_control_table(spark, sf))
    req = flow.storage_requests(items, env="dev")
    return first_per_key(req, ["databaseName", "tableName"], ["row_id", "pos"]).drop("row_id", "pos")
