"""Nulls, empty and very long texts, ties and repeated rows, empty tables, clashing columns."""

import random

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from sluice.llm import op1_search, op3_resample, op4_lines, op5_packing, op6_quality, op7_pieces
from sluice.llm.op2_minhash import near_duplicates
from sluice.llm.op8_pii import find_pii, mask_pii
from sluice.llm.op9_html import main_text
from sluice.llm.op10_chains import fuzzy_passages

SCHEMA = ("doc_id long, text string, lang string, source string, n_chars long, h string, node string, key string, "
          "n_lines string, kept string, rest string, bin_id string, component_id string, sig string")
_rng = random.Random(5)
LONG = "\n".join(" ".join(f"w{_rng.randrange(9000)}" for _ in range(12)) for _ in range(3000))
COPY = " ".join(f"c{i}" for i in range(60))


def row(i, text, source="s0"):
    return (i, text, "en", source, len(text or ""), *["x"] * 9)


ROWS = [row(1, COPY), row(2, None), row(3, ""), row(4, " \n\t\n "), row(None, "no id here " * 30), row(5, LONG),
        row(6, COPY), row(6, COPY), row(7, "one two", None), row(8, "mail a.b@c.org now", None), row(9, None, None),
        row(10, "ONE  two"), row(None, None, None)]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(ROWS, SCHEMA)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def labels(spark, rows=((1, 1, 0), (5, 1, 0), (3, 0, 0), (None, 1, 0), (7, None, None))):
    return spark.createDataFrame(list(rows), "doc_id long, quality int, toxic int")


def test_near_duplicates(docs, empty):
    got = {r.doc_id: r for r in near_duplicates(docs).collect()}
    assert (got[1].component_id, got[6].component_id) == (1, 1)
    assert got[1].kept and not got[6].kept
    assert got[1].n_shingles == 56 and got[5].n_shingles > 30_000
    for i in (2, 3, 4, 9):
        assert (got[i].n_shingles, got[i].component_id, got[i].kept) == (0, i, True)
    assert got[7].component_id == got[10].component_id == 7  # short texts: the whole sequence
    assert got[None].kept and got[None].component_id is None
    assert near_duplicates(docs).count() == len(ROWS)
    assert near_duplicates(empty).count() == 0


def test_resample(spark, docs, empty):
    got = op3_resample.resample(docs, labels(spark), share=0.5).collect()
    assert len(got) == len(ROWS)
    assert sum(r.kept for r in got) in (6, 7)  # the repeated row ties with itself
    assert {r.n_grams for r in got if r.doc_id in (2, 3, 4)} == {0}
    six = [(r.noisy, r.kept) for r in got if r.doc_id == 6]
    assert six[0] == six[1]
    assert op3_resample.resample(empty, labels(spark)).count() == 0
    none = op3_resample.resample(docs, labels(spark, [(99, 0, 1)]), share=1.0).collect()
    assert all(r.kept and r.log_weight == 0 for r in none)


def test_line_dedup(docs, empty):
    out = op4_lines.dedup_lines(docs)
    assert out.columns == [c for c in docs.columns if c != "n_lines"] + ["n_lines", "n_removed_lines"]
    got = out.collect()
    assert len(got) == len(ROWS)
    by_id = {r.doc_id: r for r in got}
    assert by_id[2].text is None and by_id[2].n_lines == 0
    assert by_id[3].text == "" and by_id[3].n_lines == 1
    assert by_id[5].text == LONG and by_id[5].n_lines == 3000
    assert op4_lines.dedup_lines(empty).count() == 0


def test_line_dedup_windows(spark):
    a, b = "p1\np2\np3\np4", "x\np2\n\np3\np4\ny"
    rows = [(1, a), (2, b), (3, b), (3, b), (None, a), (4, "k\nk\nk\nk\nk")]
    out = op4_lines.dedup_lines(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    got = [(r.doc_id, r.text, r.n_removed_lines) for r in out]
    assert (1, a, 0) in got and (None, a, 0) in got  # first place; no id
    assert (2, "x\n\ny", 3) in got  # the blank line stays
    assert got.count((3, "\n".join([""]), 5)) == 2  # both copies alike
    assert (4, "k", 4) in got or (4, "", 5) in got


def test_packing(docs, empty):
    got = op5_packing.pack(docs, capacity=100).collect()
    assert {r.doc_id for r in got} == {r[0] for r in ROWS}
    assert sum(r.n_words for r in got if r.doc_id == 5) == 36_000
    assert all(r.bin_id is None for r in got if r.doc_id in (2, 3, 4, 9))
    six = [r.bin_id for r in got if r.doc_id == 6]
    assert len(six) == 2 and six[0] != six[1]
    assert op5_packing.pack(empty).count() == 0
    given = op5_packing.pack(docs, cluster_col="lang", capacity=100).collect()  # one cluster: nothing shares a bin
    used = [r.bin_id for r in given if r.bin_id is not None]
    assert len(used) == len(set(used))


def test_quality(docs, empty):
    got = op6_quality.quality(docs).collect()
    assert len(got) == len(ROWS)
    by_id = {r.doc_id: r for r in got}
    for i in (2, 3, 4, 9):
        assert (by_id[i].n_words, by_id[i].base_failed, by_id[i].kept) == (0, True, False)
    assert by_id[1].kept and by_id[6].kept and by_id[5].kept
    assert op6_quality.quality(empty).count() == 0


def test_pieces(docs, empty):
    got = op7_pieces.encode(docs)
    rows = got.collect()
    assert len(rows) == len(ROWS) and all(r.lossless for r in rows)
    assert {r.n_pieces for r in rows if r.doc_id in (2, 3)} == {0}
    back = {r.doc_id: r.text for r in op7_pieces.decode(got).collect()}
    assert back[5] == LONG and back[2] == "" and back[4] == " \n\t\n "
    assert op7_pieces.encode(empty).count() == 0


def test_pii(docs, empty):
    got = {r.doc_id: r for r in find_pii(docs).collect()}
    assert got[8].spans.startswith("email:5:14") and got[8].n_email == 1
    assert got[2].spans == "" == got[3].spans
    masked = mask_pii(docs)
    assert masked.columns == docs.columns
    rows = masked.collect()
    assert len(rows) == len(ROWS)
    by_id = {r.doc_id: r.text for r in rows}
    assert by_id[8] == "mail <EMAIL> now" and by_id[2] is None and by_id[5] == LONG
    assert find_pii(empty).count() == 0 and mask_pii(empty).count() == 0


def test_pages(spark):
    schema = "page_id long, url string, html string, h string, lines string, host string"
    rows = [(1, "http://a.org/1", "<p>x &amp;  y</p>", "k", "k", "k"), (2, None, None, "k", "k", "k"),
            (3, "", "", "k", "k", "k"), (None, "http://a.org/1", "<article>z", "k", "k", "k"),
            (1, "http://a.org/1", "<p>x &amp;  y</p>", "k", "k", "k"),
            (4, "http://a.org/9", "<div>" + "<p>long line</p>" * 20_000 + "</div>", "k", "k", "k")]
    got = main_text(spark.createDataFrame(rows, schema)).collect()
    assert len(got) == len(rows)
    assert [r.text for r in got if r.page_id == 1] == ["x & y"] * 2
    assert {(r.text, r.n_chars) for r in got if r.page_id in (2, 3)} == {("", 0)}
    assert [r.text for r in got if r.page_id is None] == ["z"]
    assert [r.n_chars for r in got if r.page_id == 4] == [20_000 * 10 - 1]
    assert main_text(spark.createDataFrame([], schema)).count() == 0


def test_passages(spark, docs, empty):
    got = fuzzy_passages(docs).collect()
    assert {(r.doc_id, r.other_doc_id) for r in got} == {(6, 1)}
    assert (got[0].start_word, got[0].end_word, got[0].n_equal) == (0, 60, 60)
    assert fuzzy_passages(empty).count() == 0


def test_search(docs, empty):
    queries = docs.withColumnRenamed("doc_id", "query_id")
    got = op1_search.search(docs, queries).collect()
    assert [r.doc_id for r in sorted((r for r in got if r.query_id == 10), key=lambda r: r.rank)][:2] == [7, 10]
    assert not any(r.query_id in (2, 3, 4) or r.doc_id in (2, 3, 4) for r in got)
    assert {r.doc_id for r in got if r.query_id == 1 and r.rank <= 3} == {1, 6}
    assert op1_search.search(empty, queries).count() == 0
    assert op1_search.search(docs, empty.withColumnRenamed("doc_id", "query_id")).count() == 0


def test_pipeline_stages(spark, docs, empty):
    for table in (docs, empty):
        cur = table
        for name, stage in corpus_pipeline.STAGES:
            out = stage(spark, cur, "")
            if name != "packing":
                assert out.columns == docs.columns, name
                out = spark.createDataFrame(out.collect(), docs.schema)
                assert out.filter(F.col("text").isNotNull() & (F.col("n_chars") != F.length("text"))).count() == 0
            cur = out
        rows = cur.collect()
        assert {r.doc_id for r in rows} == (set() if table is empty else {1, 5})
