import pytest
from pyspark.sql import functions as F

from sluice.operators.lookup import insert_if_absent, lookup, lookup_misses
from sluice.operators.quality import ValidationError
from sluice.operators.setops import missing_columns, union_by_name
from sluice.plans import flow

from .conftest import write_text


def test_lookup_first_match_and_broadcast_when_checked(spark):
    left = spark.createDataFrame([("a",), ("b",), ("c",)], "k string")
    right = spark.createDataFrame([("a", 2, "second"), ("a", 1, "first"), ("B", 1, "upper")],
                                  "k string, o int, v string")
    out = lookup(left, right, "k", "k", order=["o"], values=["v"], hit_col="hit")
    got = sorted((r.k, r.v, r.hit) for r in out.collect())
    assert got == [("a", "first", True), ("b", None, False), ("c", None, False)]
    assert "BroadcastHashJoin" in out._jdf.queryExecution().executedPlan().toString()
    miss = lookup_misses(left, right, "k", "k")
    assert sorted(r.k for r in miss.collect()) == ["b", "c"]


def test_insert_if_absent_no_growth_on_rerun(spark):
    existing = spark.createDataFrame([("s", "t1", 0)], "db string, t string, seq int")
    incoming = spark.createDataFrame([("s", "t1", 1), ("s", "t2", 2), ("s", "t2", 3)],
                                     "db string, t string, seq int")
    new = insert_if_absent(existing, incoming, ["db", "t"], ["seq"])
    assert [(r.t, r.seq) for r in new.collect()] == [("t2", 2)]
    table = union_by_name([existing, new])
    assert insert_if_absent(table, incoming, ["db", "t"], ["seq"]).count() == 0


def test_union_by_name_fills_missing(spark):
    a = spark.createDataFrame([(1, "x")], "a int, b string")
    b = spark.createDataFrame([(2, 3.0)], "a int, c double")
    rows = union_by_name([a, b]).orderBy("a").collect()
    assert rows[0].c is None and rows[1].b is None
    assert missing_columns(a, ["a", "c", "d"]) == ["c", "d"]


CONTROL = """icdsTableName,BANNER_NAME,dataSensitivity,OP-Company code,dlSchemaName,dlTableName,tableLoadType,keyPreCombine,keyPrimaryKey,bucket_id
SRCA,"MDD,MAK,MSB",se,"X-1,X-2,X-3",dl_zone_one,ITEM_DOC,INC,ds_load_ts,"k1,k2",101
SRCB,"MDD,MAK,MSB",hs,"X-1,X-2,X-3",dl_zone_two,ITEM_DOC,full,ds_load_ts,"k1,k2",102
"""

# Storage portal export (invented): only the columns the mapping reads plus noise.
EXPORT = """bucketNameType,databaseName,tableName,bucket_name,labels,error
hash,dl_zone_one,mdd_item_doc,id-one-mdd,"{'a': 'b', 'c': 'd'}",
hash,dl_zone_one,MAK_ITEM_DOC,id-one-mak,"{}",
hash,dl_zone_one,mak_item_doc,id-one-mak-late,"{}",
hash,dl_zone_two,mdd_item_doc,id-two-mdd,"{}",
hash,dl_zone_one,msb_item_doc,12e5,"{}",
"""


def test_control_flow_end_to_end(spark, tmp_dir):
    c = write_text(f"{tmp_dir}/control.csv", CONTROL)
    m = write_text(f"{tmp_dir}/export.csv", EXPORT, newline="\r\n")
    log = f"{tmp_dir}/requests"
    run = flow.run(spark, c, m, env="dev", request_log_path=log)
    items = run.items.orderBy("row_id", "pos").collect()
    assert [i.unit_name for i in items] == [
        "INTLDLDAT-SAMDD-INC-DL_ZONE_ONE-MDD_ITEM_DOC", "INTLDLDAT-SAMAK-INC-DL_ZONE_ONE-MAK_ITEM_DOC",
        "INTLDLDAT-SAMSB-INC-DL_ZONE_ONE-MSB_ITEM_DOC", "INTLDLDAT-SAMDD-FULL-DL_ZONE_TWO-MDD_ITEM_DOC",
        "INTLDLDAT-SAMAK-FULL-DL_ZONE_TWO-MAK_ITEM_DOC", "INTLDLDAT-SAMSB-FULL-DL_ZONE_TWO-MSB_ITEM_DOC"]
    assert [i.cluster_name for i in items][:1] == ["dl-zone-one-mdd-item-doc"]
    assert [i.bucket_id for i in items] == ["id-one-mdd", "id-one-mak", "12e5", "id-two-mdd", None, None]
    assert [i.status for i in items] == ["ok"] * 4 + ["error"] * 2
    assert items[4].error == "Table 'mak_item_doc' not found in mapping"
    assert items[0].lake_path == "gs://id-one-mdd/mdd_item_doc"
    summary = {(r.status, r.error_class): r["items"] for r in run.summary.collect()}
    assert summary == {("ok", None): 4, ("error", "not_found"): 2}
    reqs = spark.read.parquet(log)
    assert reqs.count() == 6
    r0 = reqs.filter("tableName = 'mdd_item_doc' AND databaseName = 'dl_zone_one'").first()
    assert r0.refreshMode == "incremental load" and r0.opCmpnyCd == "SA-MDD"
    assert r0.storage_uploader == "svc-ingest-ns@lake-ns-dev.example"
    r1 = reqs.filter("databaseName = 'dl_zone_two'").first()
    assert r1.refreshMode == "full load" and r1.storage_uploader.startswith("svc-ingest-hs@")
    # Re-run: the request log does not grow.
    flow.run(spark, c, m, env="dev", request_log_path=log)
    assert spark.read.parquet(log).count() == 6


def test_control_flow_table_only_mapping_key(spark, tmp_dir):
    c = write_text(f"{tmp_dir}/control.csv", CONTROL)
    m = write_text(f"{tmp_dir}/export.csv", EXPORT)
    run = flow.run(spark, c, m, by_schema=False)
    ids = [i.bucket_id for i in run.items.orderBy("row_id", "pos").collect()]
    # Table-only key: both schemas share one id per table; first export row wins.
    assert ids == ["id-one-mdd", "id-one-mak", "12e5", "id-one-mdd", "id-one-mak", "12e5"]


def test_control_flow_validation_and_dry_run(spark, tmp_dir):
    bad = CONTROL.replace('"MDD,MAK,MSB",hs', '"MDD,XXX",hs')
    c = write_text(f"{tmp_dir}/control.csv", bad)
    m = write_text(f"{tmp_dir}/export.csv", EXPORT)
    with pytest.raises(ValidationError, match="Row 2"):
        flow.run(spark, c, m, request_log_path=f"{tmp_dir}/req")
    import os
    assert not os.path.exists(f"{tmp_dir}/req")
    good = write_text(f"{tmp_dir}/good.csv", CONTROL)
    run = flow.run(spark, good, m, dry_run=True)
    assert run.items is None and run.findings.count() == 0
    with pytest.raises(RuntimeError):
        flow.run(spark, good, m, fail_on_item_error=True)
    assert F is not None


def test_mapping_drops_failed_rows_when_asked(spark, tmp_dir):
    from sluice.sources.control import read_csv_text
    export = ("databaseName,tableName,bucket_name,error\n"
              "s,t_one,id-bad,quota exceeded\n"
              "s,t_one,id-good,\n")
    m = write_text(f"{tmp_dir}/export.csv", export)
    df = read_csv_text(spark, m)
    first = flow.storage_mapping(df).collect()
    assert [r.bucket_id for r in first] == ["id-bad"]
    ok = flow.storage_mapping(df, only_created=F.col("error").isNull()).collect()
    assert [r.bucket_id for r in ok] == ["id-good"]


def test_small_left_against_big_right_never_shuffles_right(spark, tmp_dir):
    big = spark.range(0, 50000).select(F.col("id").cast("string").alias("k"))
    # Tables whose size the planner knows; it chooses the broadcasts.
    spark.createDataFrame([("5",), ("x",), ("y",)], "k string").write.parquet(f"{tmp_dir}/small")
    spark.createDataFrame([("5", 1), ("z", 2), ("z", 3)], "k string, seq int").write.parquet(f"{tmp_dir}/incoming")
    small = spark.read.parquet(f"{tmp_dir}/small")
    miss = lookup_misses(small, big, "k", "k", few_left=True)
    assert sorted(r.k for r in miss.collect()) == ["x", "y"]
    plan = miss._jdf.queryExecution().executedPlan().toString()
    assert "LeftSemi" in plan and "SortMergeJoin" not in plan
    new = insert_if_absent(big, spark.read.parquet(f"{tmp_dir}/incoming"), ["k"], ["seq"])
    assert [(r.k, r.seq) for r in new.collect()] == [("z", 2)]
    assert "SortMergeJoin" not in new._jdf.queryExecution().executedPlan().toString()


def test_cli(spark, tmp_dir, capsys):
    from sluice.__main__ import main
    c = write_text(f"{tmp_dir}/control.csv", CONTROL)
    m = write_text(f"{tmp_dir}/export.csv", EXPORT)
    assert main(["-i", c, "-m", m, "--dry-run"], spark=spark) == 0
    rc = main(["-i", c, "-m", m, "--items-out", f"{tmp_dir}/items",
               "--request-log", f"{tmp_dir}/req"], spark=spark)
    assert rc == 1  # two items do not resolve
    assert spark.read.parquet(f"{tmp_dir}/items").count() == 6
    out = capsys.readouterr().out
    assert "ok\t\t4" in out and "error\tnot_found\t2" in out
    bad = write_text(f"{tmp_dir}/bad.csv", CONTROL.replace(",se,", ",xx,"))
    assert main(["-i", bad, "-m", m], spark=spark) == 1


def test_shuffle_lookup_with_hot_key(spark):
    # One key holds a third of the left rows; with broadcasts off the join
    # shuffles (AQE may split the partition); results whole.
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    hot = spark.range(0, 20000).select(F.lit("h").alias("k"), F.col("id"))
    cold = spark.range(0, 40000).select(F.col("id").cast("string").alias("k"), F.col("id"))
    left = hot.unionByName(cold)
    right = spark.range(0, 40000).select(F.col("id").cast("string").alias("k"),
                                         F.lit(1).alias("o"), (F.col("id") * 2).alias("v"))
    right = right.unionByName(spark.createDataFrame([("h", 1, -1), ("h", 0, -2)], "k string, o int, v long"))
    out = lookup(left, right, "k", "k", order=["o"], values=["v"], hit_col="hit")
    assert out.count() == 60000
    assert out.filter("k = 'h'").select("v").distinct().collect()[0].v == -2
    assert out.filter("NOT hit").count() == 0
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_null_keys_are_not_inserted_again(spark):
    existing = spark.createDataFrame([("s", None)], "db string, t string")
    incoming = spark.createDataFrame([("s", None, 1), ("s", "x", 2), (None, None, 3)], "db string, t string, seq int")
    new = insert_if_absent(existing, incoming, ["db", "t"], ["seq"])
    assert sorted(r.seq for r in new.collect()) == [2, 3]


def test_no_job_while_a_plan_is_built(spark):
    items = spark.range(50).select(F.col("id").cast("string").alias("table_name"), F.lit("s").alias("schema"))
    mapping = spark.range(50).select(F.col("id").cast("string").alias("dlTableName"), F.lit("s").alias("dlSchemaName"),
                                     F.lit("b").alias("bucket_id"))
    spark.sparkContext.setJobGroup("plan-only", "no job may run")
    out = flow.resolve_items(items, mapping)
    lookup_misses(items, mapping, "table_name", "dlTableName", few_left=True)
    insert_if_absent(items, items.withColumn("o", F.lit(1)), ["table_name"], ["o"])
    assert list(spark.sparkContext.statusTracker().getJobIdsForGroup("plan-only")) == []
    assert out.filter("status = 'ok'").count() == 50
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_fields_beyond_the_header_are_findings(spark, tmp_dir):
    c = write_text(f"{tmp_dir}/c.csv", CONTROL.replace('"MDD,MAK,MSB",hs', "MDD,MAK,MSB,hs") + "SRCC,MDD\n")
    m = write_text(f"{tmp_dir}/e.csv", EXPORT)
    with pytest.raises(ValidationError) as e:
        flow.run(spark, c, m, findings_path=f"{tmp_dir}/findings")
    bad = {r.row_id for r in e.value.findings.filter("rule_id = 'row_malformed'").collect()}
    assert bad == {2, 3}
    assert spark.read.parquet(f"{tmp_dir}/findings").count() == e.value.findings.count()
    from sluice.sources.control import read_csv_text
    with pytest.raises(Exception, match="wrong number of fields"):
        read_csv_text(spark, c).select("dlTableName").collect()


def test_gate_reports_all_findings(spark):
    from sluice.operators import quality as Q
    df = spark.range(700).withColumn("v", F.lit(None).cast("string"))
    with pytest.raises(ValidationError, match="700 validation") as e:
        Q.gate(df, [Q.Rule("r", "v", "not_blank")], "id")
    assert e.value.findings.count() == 700


def test_cli_loads_the_items(spark, tmp_dir, capsys):
    from sluice.__main__ import main
    src = f"{tmp_dir}/source"
    spark.createDataFrame([(1, "a", "x"), (2, "b", "y")], "k1 int, k2 string, v string").write.parquet(f"{src}/SRCA.parquet")
    spark.createDataFrame([(3, "c", "z")], "k1 int, k2 string, v string").write.parquet(f"{src}/SRCB.parquet")
    c = write_text(f"{tmp_dir}/control.csv", CONTROL)
    m = write_text(f"{tmp_dir}/export.csv", EXPORT)
    args = ["-i", c, "-m", m, "--load-from", src, "--raw-root", f"{tmp_dir}/raw", "--lake-root", f"{tmp_dir}/lake",
            "--run-id", "night1", "--buckets", "2"]
    assert main([*args, "--allow-item-errors"], spark=spark) == 0
    assert main(args, spark=spark) == 1  # two items are not in the mapping
    out = capsys.readouterr()
    assert "load run night1" in out.out and "not_found" in out.err
    assert sorted(r.v for r in spark.table("dl_zone_one.mak_item_doc").collect()) == ["x", "y"]
    assert [r.v for r in spark.table("dl_zone_two.mdd_item_doc").collect()] == ["z"]
    with pytest.raises(SystemExit):
        main(["-i", c, "-m", m, "--load-from", src], spark=spark)
    for d in ("dl_zone_one", "dl_zone_two"):
        spark.sql(f"DROP DATABASE {d} CASCADE")
