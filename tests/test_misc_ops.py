from pyspark.sql import functions as F

from sluice.functions.text import split_literal
from sluice.operators.explode import explode_list, per_row_list, zip_lists
from sluice.operators.outcomes import counts, run_summary, with_outcome
from sluice.operators.topk import preview, sorted_listing
from sluice.sinks import lake


def test_zip_lists_positional(spark):
    df = spark.createDataFrame([("MDD,MAK", "t_mdd,t_mak")], "b string, t string")
    z = df.select(zip_lists(split_literal("b"), split_literal("t")).alias("z")).first().z
    assert [tuple(x) for x in z] == [("MDD", "t_mdd"), ("MAK", "t_mak")]


def test_explode_keeps_order_duplicates_and_strips(spark):
    df = spark.createDataFrame([(1, " MDD , MDD,MAK ")], "id int, l string")
    rows = explode_list(df, "l", value_col="banner").orderBy("pos").collect()
    assert [(r.pos, r.banner) for r in rows] == [(0, "MDD"), (1, "MDD"), (2, "MAK")]
    names = df.select(per_row_list("l", lambda x: F.lower(x)).alias("n")).first().n
    assert names == ["mdd", "mdd", "mak"]


def test_counts_outcomes_summary(spark):
    df = spark.createDataFrame([(1, None), (2, "x"), (3, "")], "id int, k string")
    c = counts(df, missing=F.col("k").isNull(), big=F.col("id") > 1).first()
    assert (c["rows"], c.missing, c.big) == (3, 1, 2)
    out = with_outcome(df, [(F.col("k").isNull(), "missing_key", F.lit("no key")),
                            (F.col("k") == "", "blank_key", F.lit("blank"))])
    got = sorted((r.id, r.status, r.error_class) for r in out.collect())
    assert got == [(1, "error", "missing_key"), (2, "ok", None), (3, "error", "blank_key")]
    summ = {(r.status, r.error_class): r["items"] for r in run_summary(out).collect()}
    assert summ == {("ok", None): 1, ("error", "missing_key"): 1, ("error", "blank_key"): 1}


def test_listing_and_preview(spark):
    df = spark.createDataFrame([(p,) for p in ["b/2", "a/9", "a/10", "c"]], "p string")
    assert [r.p for r in sorted_listing(df, ["p"]).collect()] == ["a/10", "a/9", "b/2", "c"]
    assert [r.p for r in preview(df, ["p"], 2).collect()] == ["a/10", "a/9"]


def test_append_and_full_load(spark, tmp_dir):
    df = spark.createDataFrame([(1, "a")], "id int, v string")
    lake.append(df, f"{tmp_dir}/t")
    lake.append(df, f"{tmp_dir}/t")
    assert spark.read.parquet(f"{tmp_dir}/t").count() == 2
    cur = spark.read.parquet(f"{tmp_dir}/t")
    assert lake.reads_path(cur, f"{tmp_dir}/t") and not lake.reads_path(cur, f"{tmp_dir}/other")
    lake.full_load(cur.withColumn("v", F.lit("b")), f"{tmp_dir}/t")
    assert [r.v for r in spark.read.parquet(f"{tmp_dir}/t").collect()] == ["b", "b"]


def test_external_table_drop_keeps_files(spark, tmp_dir):
    df = spark.createDataFrame([(1, "a"), (2, "b")], "id int, part string")
    lake.overwrite(df, f"{tmp_dir}/ext", partition_by=["part"])
    lake.register_external_table(spark, "sluice_test_ext", f"{tmp_dir}/ext", df,
                                 partition_by=["part"], comments={"id": "key - PRIMARY KEY"})
    assert spark.table("sluice_test_ext").filter("part = 'b'").count() == 1
    desc = {r.col_name: r.comment for r in spark.sql("DESCRIBE TABLE sluice_test_ext").collect()}
    assert desc["id"] == "key - PRIMARY KEY"
    spark.sql("DROP TABLE sluice_test_ext")
    assert spark.read.parquet(f"{tmp_dir}/ext").count() == 2


def test_publish_snapshot_switches_location(spark, tmp_dir):
    from sluice.sinks.lake import publish_snapshot
    v1 = spark.createDataFrame([(1, "a"), (2, "b")], "id int, v string")
    p1 = publish_snapshot(spark, v1, "sluice_pub_t", f"{tmp_dir}/pub", "0001")
    assert sorted(r.id for r in spark.table("sluice_pub_t").collect()) == [1, 2]
    v2 = spark.table("sluice_pub_t").filter("id = 2").withColumn("v", F.lit("c"))
    p2 = publish_snapshot(spark, v2, "sluice_pub_t", f"{tmp_dir}/pub", "0002")
    assert [(r.id, r.v) for r in spark.table("sluice_pub_t").collect()] == [(2, "c")]
    # The previous snapshot is untouched for readers that still hold it.
    assert spark.read.parquet(p1).count() == 2 and p1 != p2
    spark.sql("DROP TABLE sluice_pub_t")


def test_publish_snapshot_partitioned_no_stale_partitions(spark, tmp_dir):
    from sluice.sinks.lake import publish_snapshot
    v1 = spark.createDataFrame([(1, "a"), (2, "b")], "id int, p string")
    publish_snapshot(spark, v1, "sluice_pub_p", f"{tmp_dir}/pp", "0001", partition_by=["p"])
    assert sorted(map(tuple, spark.table("sluice_pub_p").collect())) == [(1, "a"), (2, "b")]
    v2 = spark.createDataFrame([(3, "a"), (4, "c d")], "id int, p string")
    publish_snapshot(spark, v2, "sluice_pub_p", f"{tmp_dir}/pp", "0002", partition_by=["p"])
    assert sorted(map(tuple, spark.table("sluice_pub_p").collect())) == [(3, "a"), (4, "c d")]
    spark.sql("DROP TABLE sluice_pub_p")


def test_reader_in_a_loop_never_misses_the_table(spark, tmp_dir):
    """K5 follows INC and FULL loads in place: the table is always there, complete."""
    import threading

    from sluice.sinks.upsert import create_table, register_table, upsert
    path, name = f"{tmp_dir}/t", "sluice_loop_t"
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    rows = [(i, 0, "a") for i in range(50)]
    upsert(spark, spark.createDataFrame(rows, "k int, ts int, v string"), path, ["k"], ["ts"], num_buckets=4)
    register_table(spark, name, path, {"k": "key"})
    counts, errors, stop = [], [], threading.Event()

    def read():
        while not stop.is_set():
            try:
                counts.append(spark.table(name).count())
            except Exception as e:
                errors.append(e)

    t = threading.Thread(target=read)
    t.start()
    for n in range(1, 4):
        upsert(spark, spark.createDataFrame([(i, n, f"n{n}") for i in range(0, 50, 7)], "k int, ts int, v string"),
               path, ["k"], ["ts"])
        register_table(spark, name, path, {"k": "key"})
    create_table(spark, spark.createDataFrame([(i, 9, "full") for i in range(50)], "k int, ts int, v string"), path,
                 ["k"], ["ts"], 4)
    register_table(spark, name, path, {"k": "the key"})
    stop.set()
    t.join()
    assert not errors and counts and set(counts) == {50}
    assert {r.v for r in spark.table(name).collect()} == {"full"}
    assert {r.col_name: r.comment for r in spark.sql(f"DESCRIBE TABLE {name}").collect()}["k"] == "the key"
    spark.sql(f"DROP TABLE {name}")


def test_external_table_adds_and_drops_only_what_changed(spark, tmp_dir):
    path, name = f"{tmp_dir}/ext2", "sluice_ext2"
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    df = spark.createDataFrame([(1, "a"), (2, "b c"), (3, None)], "id int, part string")
    lake.overwrite(df, path, partition_by=["part"])
    lake.register_external_table(spark, name, path, df, ["part"])
    assert spark.table(name).count() == 3 and spark.table(name).filter("part is null").count() == 1
    df2 = spark.createDataFrame([(1, "a", 0.5), (4, "d", 1.5)], "id int, part string, w double")
    lake.overwrite(df2, path, partition_by=["part"])
    lake.register_external_table(spark, name, path, df2, ["part"])
    assert sorted((r.id, r.part, r.w) for r in spark.table(name).collect()) == [(1, "a", 0.5), (4, "d", 1.5)]
    spark.sql(f"DROP TABLE {name}")


def test_failed_self_overwrite_keeps_the_rows(spark, tmp_dir, monkeypatch):
    import glob

    import pytest
    path = f"{tmp_dir}/self"
    lake.overwrite(spark.range(5).toDF("id"), path)
    from pyspark.sql.readwriter import DataFrameWriter

    def lost(self, p):
        import shutil
        shutil.rmtree(path)  # the old data is gone, and then the write fails
        raise RuntimeError("lost executor")

    monkeypatch.setattr(DataFrameWriter, "save", lost)
    with pytest.raises(RuntimeError, match="lost executor") as e:
        lake.overwrite(spark.read.parquet(path), path)
    monkeypatch.undo()
    staged = e.value.__notes__[0].split(" in ")[-1]
    assert sorted(r.id for r in spark.read.parquet(staged).collect()) == [0, 1, 2, 3, 4]
    assert not glob.glob(f"{path}/*")


def test_append_run_is_exactly_once(spark, tmp_dir):
    path = f"{tmp_dir}/log"
    for run, n in (("r1", 3), ("r2", 4), ("r1", 3)):
        lake.append_run(spark.range(n).toDF("id"), path, run)
    got = spark.read.parquet(path).groupBy("run_id").count().collect()
    assert sorted((r.run_id, r["count"]) for r in got) == [("r1", 3), ("r2", 4)]


def test_sorted_positions(spark):
    from sluice.operators.topk import sorted_positions
    df = spark.range(5000).select(((F.col("id") * 7919) % 1000).cast("int").alias("a"), F.col("id").alias("b"))
    rows = sorted_positions(df, [F.col("a").desc(), F.col("b")]).collect()
    want = sorted(((r.a, r.b) for r in df.collect()), key=lambda x: (-x[0], x[1]))
    assert [(r.a, r.b) for r in sorted(rows, key=lambda r: r.position)] == want
    assert sorted(r.position for r in rows) == list(range(1, 5001))
    assert sorted_positions(df.limit(0), ["a"]).count() == 0
