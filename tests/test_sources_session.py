import datetime as dt

import pytest
from pyspark.sql import functions as F

from sluice.session import shared_root
from sluice.sinks.lake import load_ts
from sluice.sources.control import read_csv_text
from sluice.sources.tables import extract_raw, table, ts_ntz

from .conftest import SF_SMALL, write_text


def test_multiline_quoted_fields(spark, tmp_dir):
    p = write_text(f"{tmp_dir}/m.csv", 'a,b\n"line one\nline two",x\n"q ""quoted"" w",NA\n')
    rows = read_csv_text(spark, p, multi_line=True).collect()
    assert rows[0].a == "line one\nline two" and rows[0].b == "x"
    assert rows[1].a == 'q "quoted" w' and rows[1].b is None


def test_extract_raw_pushes_filter_and_prunes_columns(spark):
    src = table(spark, SF_SMALL, "orders")
    ext = extract_raw(src, F.col("o_orderdate") >= ts_ntz("1998-01-01"), ["o_orderkey", "o_totalprice"],
                      load_ts(dt.datetime(2024, 1, 2, 3, 4, 5)), {"banner": F.lit("MAK")})
    plan = ext._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(o_orderdate" in plan
    assert "ReadSchema: struct<o_orderkey:bigint,o_totalprice:double,o_orderdate:timestamp_ntz>" in plan
    r = ext.first()
    assert r.banner == "MAK" and r.ds_load_ts == dt.datetime(2024, 1, 2, 3, 4, 5)


class _Conf:
    def __init__(self, values):
        self.values = values

    def get(self, key, default=None):
        return self.values.get(key, default)


class _Ctx:
    def __init__(self, master):
        self.master = master

    def getCheckpointDir(self):
        return None


class _Session:
    def __init__(self, master, values):
        self.conf = _Conf(values)
        self.sparkContext = _Ctx(master)


def test_shared_root_policy():
    assert shared_root(_Session("yarn", {"spark.sluice.lake.root": "s3://lake/root/"})) == "s3://lake/root"
    assert shared_root(_Session("yarn", {"spark.checkpoint.dir": "hdfs:///ckpt"})) == "hdfs:///ckpt"
    with pytest.raises(RuntimeError, match="shared folder"):
        shared_root(_Session("yarn", {}))


def test_csv_files_are_read_by_their_own_header(spark, tmp_dir):
    import os

    from sluice.sources.control import with_row_number
    os.makedirs(f"{tmp_dir}/c")
    write_text(f"{tmp_dir}/c/a.csv", "x,y\n1,a\n2,b\n")
    write_text(f"{tmp_dir}/c/b.csv", "y,x\nc,3\n")
    write_text(f"{tmp_dir}/c/c.csv", "y\nd\nNA\n")
    write_text(f"{tmp_dir}/c/d.csv", "x,y\n5,e\n")
    df = read_csv_text(spark, f"{tmp_dir}/c", keep_place=True)
    rows = [(r.row_num, r.x, r.y) for r in with_row_number(df).collect()]
    assert sorted(rows) == [(1, "1", "a"), (2, "2", "b"), (3, "3", "c"), (4, None, "d"), (5, None, None), (6, "5", "e")]
    write_text(f"{tmp_dir}/c/e.csv", "y,x\nonly-one\n")
    bad = read_csv_text(spark, f"{tmp_dir}/c", keep_malformed=True).filter("_malformed is not null").collect()
    assert [r._malformed for r in bad] == ["only-one"]
    with pytest.raises(Exception, match="wrong number of fields"):
        read_csv_text(spark, f"{tmp_dir}/c").collect()


def test_parquet_row_numbers_scan_the_data_once(spark, tmp_dir):
    from sluice.sources.control import parquet_with_row_number
    path = f"{tmp_dir}/p"
    spark.range(0, 10_000, 1, 7).selectExpr("id AS k", "repeat('x', 20) AS v").write.parquet(path)
    df = parquet_with_row_number(spark, path)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan parquet [k#") == 1 and plan.count("FileScan") == 2 and "file_offsets" in plan
    rows = df.select("k", "row_num").collect()
    assert sorted(r.row_num for r in rows) == list(range(1, 10_001))
    by_number = [r.k for r in sorted(rows, key=lambda r: r.row_num)]
    assert by_number == [r.k for r in spark.read.parquet(path).orderBy("_metadata.file_path", "_metadata.row_index")
                         .select("k").collect()]
