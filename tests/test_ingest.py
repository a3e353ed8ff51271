import datetime as dt

import pytest
from pyspark.sql import functions as F

from sluice.plans.ingest import key_list, load_item
from sluice.sinks.upsert import read_meta, snapshot

T0 = dt.datetime(2024, 3, 1, 6, 0, 0)
T1 = dt.datetime(2024, 3, 2, 6, 0, 0)


def test_key_list():
    assert key_list(" clnt, site ,artcl") == ["clnt", "site", "artcl"]
    with pytest.raises(ValueError):
        key_list(" , ")


def test_inc_then_full(spark, tmp_dir):
    path = f"{tmp_dir}/item"
    day1 = spark.createDataFrame([("a", 1, "x"), ("b", 1, "y")], "clnt string, site int, v string")
    r1 = load_item(spark, day1, path, "inc", "clnt, site", "ds_load_ts", T0, num_buckets=4)
    assert r1.metrics["rows_written"] == 2
    day2 = spark.createDataFrame([("a", 1, "x2"), ("c", 2, "z")], "clnt string, site int, v string")
    load_item(spark, day2, path, "INC", "clnt,site", "ds_load_ts", T1)
    got = {(r.clnt, r.site): (r.v, r.ds_load_ts) for r in snapshot(spark, path).collect()}
    assert got == {("a", 1): ("x2", T1), ("b", 1): ("y", T0), ("c", 2): ("z", T1)}
    assert read_meta(spark, path)["keys"] == ["clnt", "site"]
    # FULL replaces the table from its own snapshot (lineage cut first).
    cur = snapshot(spark, path).select("clnt", "site", "v", "ds_load_ts").filter(F.col("clnt") != "b")
    load_item(spark, cur, path, "FULL", "clnt,site", "ds_load_ts", T1)
    assert sorted(r.clnt for r in snapshot(spark, path).collect()) == ["a", "c"]


def test_bad_items(spark, tmp_dir):
    df = spark.createDataFrame([("a",)], "clnt string")
    with pytest.raises(ValueError, match="lacks"):
        load_item(spark, df, f"{tmp_dir}/x", "INC", "clnt,site", "ds_load_ts", T0, num_buckets=2)
    with pytest.raises(ValueError, match="load type"):
        load_item(spark, df, f"{tmp_dir}/x", "DELTA", "clnt", "ds_load_ts", T0, num_buckets=2)


def test_unknown_source_size_needs_a_bucket_count(spark, tmp_dir, monkeypatch):
    from sluice.plans import ingest
    monkeypatch.setattr(ingest, "UNKNOWN_BYTES", 0)
    df = spark.createDataFrame([("a", 1)], "k string, v int")
    with pytest.raises(ValueError, match="num_buckets is required"):
        load_item(spark, df, f"{tmp_dir}/x", "INC", "k", "ds_load_ts", T0)
    load_item(spark, df, f"{tmp_dir}/x", "INC", "k", "ds_load_ts", T0, num_buckets=2)
    load_item(spark, df, f"{tmp_dir}/x", "INC", "k", "ds_load_ts", T1)  # the table's own count


def test_run_items_goes_on_after_a_failure(spark, tmp_dir):
    from sluice.plans.ingest import run_items
    items = spark.createDataFrame(
        [("good", "s", "INC", "k", "ds_load_ts", f"{tmp_dir}/good", "ok", None, None),
         ("bad", "s", "INC", "nokey", "ds_load_ts", f"{tmp_dir}/bad", "ok", None, None),
         ("lost", "s", "INC", "k", "ds_load_ts", None, "error", "not_found", "no storage")],
        "table_name string, schema string, load_type string, primary_key string, precombine string, "
        "lake_path string, status string, error_class string, error string")
    src = spark.createDataFrame([("a", 1), (None, 2)], "k string, v int")
    spark.sql("CREATE DATABASE IF NOT EXISTS run_items_test")
    run = run_items(spark, items, lambda i: src, f"{tmp_dir}/raw", T0, "r1", database="run_items_test", num_buckets=2)
    got = {r.table_name: r for r in run.outcomes.collect()}
    assert (got["good"].status, got["good"].rows_raw, got["good"].rows_written, got["good"].rows_quarantined) == (
        "ok", 2, 1, 1)
    assert got["bad"].error_class == "load_failed" and got["lost"].error_class == "not_found"
    desc = {r.col_name: r.comment for r in spark.sql("DESCRIBE TABLE run_items_test.good").collect()}
    assert desc["k"] == "PRIMARY KEY" and desc["_record_key"] == "commit column"
    assert spark.table("run_items_test.good").count() == 1
    spark.sql("DROP DATABASE run_items_test CASCADE")


ITEM = ("table_name string, schema string, load_type string, primary_key string, precombine string, lake_path string, "
        "status string, error_class string, error string, banner string, extract_filter string, watermark string")


def _item(tmp_dir, name, filt=None, mark=None):
    return (name, "s", "INC", "k", "ds_load_ts", f"{tmp_dir}/{name}", "ok", None, None, name.split("_")[0], filt, mark)


def test_killed_run_resumes(spark, tmp_dir, monkeypatch):
    """A run cut off in the middle of an item goes on where it stopped; nothing is loaded twice."""
    from sluice.plans import ingest
    items = spark.createDataFrame([_item(tmp_dir, f"t{i}") for i in range(6)], ITEM)
    src = spark.createDataFrame([(i, i) for i in range(10)], "k int, v int")
    spark.sql("CREATE DATABASE IF NOT EXISTS resume_test")
    calls = []

    def source(item):
        calls.append(item["table_name"])
        return src

    real, logged = ingest._log_outcome, []

    class Killed(BaseException):
        pass

    def dies(sp, log, outcome):
        if len(logged) >= 3:
            raise Killed  # the driver is gone: loaded, but no outcome
        logged.append(outcome["table_name"])
        real(sp, log, outcome)

    monkeypatch.setattr(ingest, "_log_outcome", dies)
    args = (spark, items, source, f"{tmp_dir}/raw", T0, "r1")
    with pytest.raises(Killed):
        ingest.run_items(*args, database="resume_test", num_buckets=2, max_parallel=2)
    monkeypatch.undo()
    calls.clear()
    run = ingest.run_items(*args, database="resume_test", num_buckets=2, max_parallel=2)
    assert sorted(calls) == sorted({f"t{i}" for i in range(6)} - set(logged))
    got = run.outcomes.collect()
    assert sorted(r.table_name for r in got) == [f"t{i}" for i in range(6)]
    assert all(r.status == "ok" and r.rows_raw == 10 for r in got)
    for i in range(6):
        t = spark.table(f"resume_test.t{i}")
        assert t.count() == 10 and [r[0] for r in t.select("_commit_time").distinct().collect()] == ["r1"]
    calls.clear()
    assert ingest.run_items(*args, database="resume_test", num_buckets=2).outcomes.count() == 6 and not calls
    spark.sql("DROP DATABASE resume_test CASCADE")


def test_extract_per_item_and_high_water(spark, tmp_dir):
    from sluice.plans.ingest import item_extract, run_items
    src = f"{tmp_dir}/src"
    rows = [(i, ["mak", "mdd"][i % 2], i, f"v{i}") for i in range(20)]
    spark.createDataFrame(rows, "k int, unit string, seq int, v string").write.parquet(src)
    items = spark.createDataFrame([_item(tmp_dir, "mak_t", "unit = '{banner}'", "seq"),
                                   _item(tmp_dir, "mdd_t", "unit = '{banner}'", "seq")], ITEM)
    first = items.filter("banner = 'mak'").first()
    plan = item_extract(spark, spark.read.parquet(src), first, "7")._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(unit), IsNotNull(seq), EqualTo(unit,mak), GreaterThan(seq,7)]" in plan
    spark.sql("CREATE DATABASE IF NOT EXISTS extract_test")

    def go(run_id, at):
        run = run_items(spark, items, lambda i: spark.read.parquet(src), f"{tmp_dir}/raw", at, run_id,
                        database="extract_test", num_buckets=2)
        return {r.table_name: (r.rows_raw, r.high_water) for r in run.outcomes.collect()}

    full = items.filter("banner = 'mdd'").withColumn("load_type", F.lit("FULL")).withColumn("table_name", F.lit("mdd_full"))
    for run_id in ("f1", "f2"):  # a FULL load takes the whole slice every time
        run = run_items(spark, full, lambda i: spark.read.parquet(src), f"{tmp_dir}/raw", T0, run_id,
                        database="extract_test", num_buckets=2, lake_path_of=lambda i: f"{tmp_dir}/full")
        assert [(r.rows_raw, r.high_water) for r in run.outcomes.collect()] == [(10, None)]
    assert go("r1", T0) == {"mak_t": (10, "18"), "mdd_t": (10, "19")}
    more = [(0, "mak", 20, "changed"), (100, "mak", 22, "new")]
    spark.createDataFrame(more, "k int, unit string, seq int, v string").write.mode("append").parquet(src)
    assert go("r2", T1) == {"mak_t": (2, "22"), "mdd_t": (0, "19")}
    got = {r.k: r.v for r in spark.table("extract_test.mak_t").collect()}
    assert len(got) == 11 and got[0] == "changed" and got[100] == "new" and got[2] == "v2"
    assert spark.table("extract_test.mdd_t").count() == 10
    spark.sql("DROP DATABASE extract_test CASCADE")
