from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from sluice.functions import names as N
from sluice.functions.codes import lower_or_default, map_code, refresh_label
from sluice.functions.text import is_blank, py_strip, split_literal, split_strip

WS = ["a b", " a", "a ", "\ta\t", " a ", " a ", "\na\r\n", "\x1ca\x1f",
      "", "   ", "　x y　", "a​b"]


def test_py_strip_matches_python(spark):
    df = spark.createDataFrame([(s,) for s in WS], "s string")
    got = [r[0] for r in df.select(py_strip("s")).collect()]
    assert got == [s.strip() for s in WS]


def test_is_blank(spark):
    df = spark.createDataFrame([(None,), ("",), (" \t ",), ("x",), (" x ",)], "s string")
    assert [r[0] for r in df.select(is_blank("s")).collect()] == [True, True, True, False, False]


def test_split_literal_keeps_empty_and_regex_chars(spark):
    df = spark.createDataFrame([("MDD,",), ("a.b.c",), ("a|b",), (",,",)], "s string")
    got = [r[0] for r in df.select(split_literal("s", ",")).collect()]
    assert got == [["MDD", ""], ["a.b.c"], ["a|b"], ["", "", ""]]
    got = [r[0] for r in df.select(split_literal("s", ".")).collect()]
    assert got == [s.split(".") for s in ["MDD,", "a.b.c", "a|b", ",,"]]
    got = [r[0] for r in df.select(split_literal("s", "|")).collect()]
    assert got == [s.split("|") for s in ["MDD,", "a.b.c", "a|b", ",,"]]


def test_split_strip(spark):
    df = spark.createDataFrame([(" MAK , MSB",), ("MDD,MDD",)], "s string")
    assert [r[0] for r in df.select(split_strip("s")).collect()] == [["MAK", "MSB"], ["MDD", "MDD"]]


def test_names(spark):
    df = spark.createDataFrame([(" Mak ", "PHYS_DOC", "dl_Secure_Zone")], "b string, t string, s string")
    r = df.select(N.table_name("b", "t").alias("tn"), N.cluster_name("s", "b", "t").alias("cn"),
                  N.unit_name(F.lit("MAK"), F.lit("INC"), "s", "t").alias("un")).first()
    assert r.tn == "mak_phys_doc"
    assert r.cn == "dl-secure-zone-mak-phys-doc"
    assert r.un == "INTLDLDAT-SAMAK-INC-DL_SECURE_ZONE-MAK_PHYS_DOC"


def test_names_null_part_gives_null(spark):
    df = spark.createDataFrame([(None, "t")], "b string, t string")
    assert df.select(N.table_name("b", "t")).first()[0] is None


_part = st.text(alphabet=st.characters(whitelist_categories=("Lu", "Ll", "Nd"),
                                       whitelist_characters="_#"), min_size=1, max_size=8)


@settings(max_examples=25, deadline=None)
@given(banner=st.text(alphabet="ABCDMKSXYZ", min_size=1, max_size=4), load=st.sampled_from(["INC", "FULL"]),
       schema=_part, table=_part)
def test_decode_is_inverse_of_encode(spark, banner, load, schema, table):
    df = spark.createDataFrame([(banner, load, schema, table)], "b string, l string, s string, t string")
    d = df.select(N.decode_unit_name(N.unit_name("b", "l", "s", "t")).alias("d")).first().d
    assert d.ok
    assert (d.banner, d.load_type, d.schema, d.table) == (banner, load, schema.upper(), table)


def test_decode_rejects_wrong_part_count(spark):
    df = spark.createDataFrame([("A-SAX-INC-S-X_T-U",), ("A-B",), (None,)], "n string")
    rows = df.select(N.decode_unit_name("n").alias("d")).collect()
    assert [r.d.ok for r in rows] == [False, False, False]
    assert all(r.d.table is None for r in rows)


def test_codes(spark):
    df = spark.createDataFrame([("se",), ("hs",), ("xx",), (None,)], "c string")
    got = [r[0] for r in df.select(map_code("c", {"se": "ns", "ns": "ns", "hs": "hs"}, "ns")).collect()]
    assert got == ["ns", "hs", "ns", "ns"]
    df = spark.createDataFrame([("INC",), ("Full",), (None,)], "c string")
    got = [r[0] for r in df.select(refresh_label(lower_or_default("c", "incremental"))).collect()]
    assert got == ["incremental load", "full load", "incremental load"]
