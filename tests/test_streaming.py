from pyspark.sql import functions as F

from sluice.sinks import lake
from sluice.sinks.upsert import snapshot
from sluice.streaming.incremental import upsert_stream

SCHEMA = "k int, ts int, v string, load_seq int"


def test_stream_applies_each_extract_once(spark, tmp_dir):
    raw, table, ckpt = f"{tmp_dir}/raw", f"{tmp_dir}/table", f"{tmp_dir}/ckpt"
    day1 = spark.createDataFrame([(i, 1, "d1", 0) for i in range(10)], SCHEMA)
    lake.append(day1.coalesce(1), raw)
    schema = spark.read.parquet(raw).schema
    upsert_stream(spark, raw, schema, table, ["k"], ["ts", "load_seq"], ckpt, num_buckets=4)
    assert snapshot(spark, table).count() == 10

    # A new extract lands; the next run applies only it (day 1 is not re-read:
    # its stale copy below would otherwise be visible through the older ts).
    day2 = spark.createDataFrame([(i, 2, "d2", 1) for i in range(5, 15)], SCHEMA)
    lake.append(day2.coalesce(1), raw)
    upsert_stream(spark, raw, schema, table, ["k"], ["ts", "load_seq"], ckpt, num_buckets=4)
    got = {r.k: r.v for r in snapshot(spark, table).collect()}
    assert len(got) == 15
    assert all(got[k] == "d1" for k in range(5)) and all(got[k] == "d2" for k in range(5, 15))

    # Nothing new: a third run is a no-op.
    before = sorted(map(tuple, snapshot(spark, table).select("k", "v", "_commit_time").collect()))
    upsert_stream(spark, raw, schema, table, ["k"], ["ts", "load_seq"], ckpt, num_buckets=4)
    after = sorted(map(tuple, snapshot(spark, table).select("k", "v", "_commit_time").collect()))
    assert before == after
    assert snapshot(spark, table).filter(F.col("_commit_time").startswith("stream-")).count() == 15


def test_stream_null_key_is_quarantined(spark, tmp_dir):
    from sluice.sinks.upsert import quarantined
    raw, table, ckpt = f"{tmp_dir}/raw", f"{tmp_dir}/table", f"{tmp_dir}/ckpt"
    lake.append(spark.createDataFrame([(1, 1, "a", 0), (None, 1, "lost?", 0)], SCHEMA).coalesce(1), raw)
    upsert_stream(spark, raw, spark.read.parquet(raw).schema, table, ["k"], ["ts"], ckpt, num_buckets=2)
    assert snapshot(spark, table).count() == 1
    assert [r.v for r in quarantined(spark, table).collect()] == ["lost?"]


def test_two_streams_keep_each_others_quarantine(spark, tmp_dir):
    from sluice.sinks.upsert import quarantined
    table = f"{tmp_dir}/table"
    for name in ("a", "b"):
        raw = f"{tmp_dir}/raw_{name}"
        lake.append(spark.createDataFrame([(1, 1, "x", 0), (None, 1, name, 0)], SCHEMA).coalesce(1), raw)
        upsert_stream(spark, raw, spark.read.parquet(raw).schema, table, ["k"], ["ts"], f"{tmp_dir}/ckpt_{name}",
                      num_buckets=2)
    assert sorted(r.v for r in quarantined(spark, table).collect()) == ["a", "b"]


def test_many_micro_batches_are_merged_in_few_rewrites(spark, tmp_dir, monkeypatch):
    from sluice.sinks.upsert import quarantined
    from sluice.streaming import incremental
    raw, table, ckpt = f"{tmp_dir}/raw", f"{tmp_dir}/table", f"{tmp_dir}/ckpt"
    merges = []

    def counted(*args, **kwargs):
        merges.append(kwargs["run_id"])
        return upsert(*args, **kwargs)

    upsert = incremental.upsert
    monkeypatch.setattr(incremental, "upsert", counted)
    rows = [[(i, 1, f"d{day}", 0) for i in range(3 * day, 3 * day + 40)] + [(None, 1, f"n{day}", 0)] for day in range(9)]
    for day in rows:
        lake.append(spark.createDataFrame(day, SCHEMA).coalesce(1), raw)
    schema = spark.read.parquet(raw).schema
    upsert_stream(spark, raw, schema, table, ["k"], ["ts", "load_seq"], ckpt, num_buckets=2, max_files_per_trigger=1)
    # Ties in the ordering: the later micro-batch wins, as if each were applied in turn.
    want = {k: v for day in rows for k, _, v, _ in day if k is not None}
    assert {r.k: r.v for r in snapshot(spark, table).collect()} == want
    assert 2 <= len(merges) <= 6
    assert sorted(r.v for r in quarantined(spark, table).collect()) == [f"n{d}" for d in range(9)]


def test_waiting_rows_of_a_failed_run_are_merged_by_the_next(spark, tmp_dir, monkeypatch):
    import pytest

    from sluice.streaming import incremental
    raw, table, ckpt = f"{tmp_dir}/raw", f"{tmp_dir}/table", f"{tmp_dir}/ckpt"
    lake.append(spark.createDataFrame([(i, 1, "d1", 0) for i in range(200)], SCHEMA).coalesce(1), raw)
    schema = spark.read.parquet(raw).schema
    args = (spark, raw, schema, table, ["k"], ["ts", "load_seq"], ckpt)
    upsert_stream(*args, num_buckets=2)
    lake.append(spark.createDataFrame([(5, 2, "d2", 0), (300, 2, "d2", 0)], SCHEMA).coalesce(1), raw)

    def crash(*_):
        raise OSError("lost")

    with monkeypatch.context() as m:
        m.setattr(incremental, "_merge_waiting", crash)
        with pytest.raises(OSError, match="lost"):
            upsert_stream(*args, num_buckets=2)
    assert snapshot(spark, table).count() == 200  # the old table, whole
    upsert_stream(*args, num_buckets=2)  # no new files
    got = {r.k: r.v for r in snapshot(spark, table).collect()}
    assert len(got) == 201 and got[5] == got[300] == "d2" and got[6] == "d1"
