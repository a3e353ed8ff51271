"""Spelling variants, learned cells, bit-sliced gains; cuts, groups and weights against brute force."""

import collections
import hashlib
import math
import random
import re
import time
import zlib

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from sluice.llm import op3_resample, op4_lines, op6_quality, op8_pii, op9_html, op11_variants, op12_cells, op13_bitsliced
from sluice.llm._text import text_slices
from sluice.llm.queries import QUERIES
from tests.conftest import SF_SMALL

UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
SCHEMA = ("doc_id long, text string, lang string, source string, n_chars long, word string, n string, key string, "
          "rank string, score string, h string, run string")


def row(i, text, source="s"):
    return (i, text, "en", source, 0, *["x"] * 7)


# --- op11 -------------------------------------------------------------------

def brute_variants(docs):
    n = collections.Counter()
    for i, text in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(UPPER)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if h % 199 == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            n[run] += 1
    n = {w: c for w, c in n.items() if len(w) >= 6 and c >= 5}

    def near(a, b):
        if len(a) == len(b):
            return sum(x != y for x, y in zip(a, b, strict=True)) == 1
        a, b = sorted((a, b), key=len)
        return len(b) - len(a) == 1 and any(b[:k] + b[k + 1:] == a for k in range(len(b)))

    by_length = collections.defaultdict(list)
    for w in n:
        by_length[len(w)].append(w)
    out, form = {}, {}
    for w in n:
        around = [v for k in (-1, 0, 1) for v in by_length[len(w) + k] if v != w and near(w, v)]
        best = min(around, key=lambda v: (-n[v], v), default=None)
        form[w] = best if best and n[best] >= 5 * n[w] else None
        out[w] = len(around)
    res = {}
    for w in n:
        root = w
        while form[root]:
            root = form[root]
        res[w] = (form[w], root, n[w], out[w], n[form[w]] if form[w] else None)
    return res


def test_variants_equal_brute_force(spark):
    rng = random.Random(3)
    base = ["".join(rng.choice("abcdeéÀß÷") for _ in range(rng.randint(5, 9))) for _ in range(60)]
    docs = []
    for d in range(80):
        ws = []
        for _ in range(120):
            w = rng.choice(base[:10] if rng.random() < 0.6 else base)
            if rng.random() < 0.15:
                k = rng.randrange(len(w))
                w = rng.choice([w[:k] + w[k + 1:], w[:k] + rng.choice("abcde") + w[k:], w[:k] + "z" + w[k + 1:], w.upper()])
            ws.append(w)
        docs.append((d if d % 9 else None, rng.choice([" ", "-1-", "\n"]).join(ws)))
    docs += [(600 + i, "gggggga " * 6 + "ggggggab " * 40 + "ggggggabc " * 250) for i in range(2)]
    docs += [(500, None), (501, ""), (502, "x" * 100_000 + " " + "kurz "), (503, "1 2 3 _"), docs[1], docs[1]]
    df = spark.createDataFrame([row(*d) for d in docs], SCHEMA)
    want = brute_variants(docs)
    assert len(want) > 60 and any(v[0] and v[1] != v[0] for v in want.values())
    got = {r.word: (r.form, r.root, r.n, r.n_near, r.form_n) for r in op11_variants.spelling_variants(df).collect()}
    assert got == want
    assert op11_variants.spelling_variants(spark.createDataFrame([], SCHEMA)).count() == 0


def test_signatures_lose_no_near_pair(spark):
    """Words with equal letters in another order share a signature but not always a key; near words always do."""
    rng = random.Random(5)
    pairs = []
    for _ in range(300):
        w = "".join(rng.choice("abcdefghijklmnopqrstuvwxyzé") for _ in range(rng.randint(6, 20)))
        k = rng.randrange(len(w))
        pairs.append((w, rng.choice([w[:k] + w[k + 1:], w[:k] + "q" + w[k:], w[:k] + "0"[:0] + "w" + w[k + 1:]])))
    pairs = [(a, b) for a, b in pairs if a != b and len(b) >= 6]
    df = spark.createDataFrame([(w, 9) for w in {x for p in pairs for x in p}], "word string, n long")
    got = {(r.word, r.near) for r in op11_variants.near_pairs(df).collect()}
    assert all(p in got and p[::-1] in got for p in pairs)


# --- op12 -------------------------------------------------------------------

def brute_nearest(rows, k=10):
    ok = [(i, np.array(v, float)) for i, v in rows
          if i is not None and v and all(c is not None and math.isfinite(c) for c in v) and any(v)]
    out = {}
    for i, v in ok:
        if i % 100 == 0:
            d = sorted((float(np.sqrt(((w - v) * (w - v)).sum())), j) for j, w in ok if j != i)
            out[i] = d[:k]
    return out


def lists(df):
    got = collections.defaultdict(list)
    for r in sorted(df.collect(), key=lambda r: (r.query_id, r.rank)):
        assert r.rank == len(got[r.query_id]) + 1
        got[r.query_id].append((r.score, r.vec_id))
    return dict(got)


def test_nearest_edges(spark):
    rng = np.random.default_rng(2)
    rows = [(i, [float(x) for x in rng.normal(size=4)]) for i in range(150)]
    rows += [(1000 + i, [1.0, 2.0, 3.0, 4.0]) for i in range(300)]  # copies: a query among them, too
    rows += [(5000, None), (None, [1.0, 0.0, 0.0, 0.0]), (5100, [0.0] * 4), (5200, [1.0, float("nan"), 0.0, 0.0]),
             (5300, [1.0, None, 0.0, 0.0]), (5400, [float("inf"), 0.0, 0.0, 0.0]), (5500, []), rows[3], rows[0]]
    schema = "vec_id long, embedding array<double>, label int, v string, h string, cell string, rank string"
    df = spark.createDataFrame([(*r, 1, "x", "x", "x", "x") for r in rows], schema)
    want = brute_nearest([*dict.fromkeys((i, tuple(v) if v is not None else None) for i, v in rows)])
    got = lists(op12_cells.nearest(df))
    assert set(got) == set(want) == {0, 100, 1000, 1100, 1200}
    for q in want:
        assert [v for _, v in got[q]] == [v for _, v in want[q]]
        assert [s for s, _ in got[q]] == [s for s, _ in want[q]]
    assert [v for _, v in got[1000]] == list(range(1001, 1011))
    assert op12_cells.nearest(spark.createDataFrame([], schema)).count() == 0
    few = spark.createDataFrame([(*r, 1, "x", "x", "x", "x") for r in rows[100:104]], schema)
    assert [v for _, v in lists(op12_cells.nearest(few))[100]] and len(lists(op12_cells.nearest(few))[100]) == 3
    # An id with two vectors, another length, and values whose squares overflow.
    odd = spark.createDataFrame([(0, [1e300, 1.0]), (0, [1.0, 1.0]), (1, [1.0, 2.0]), (2, [5.0]), (3, [-1e300, 1.0])],
                                "vec_id long, embedding array<double>")
    found = op12_cells.nearest(odd).filter("query_id = 0").collect()
    assert {r.vec_id for r in found} == {1, 3} and all(r.score > 0 for r in found)
    assert op12_cells.nearest(odd).filter("vec_id = 2").count() == 0


def test_recall_of_learned_cells(spark, monkeypatch):
    monkeypatch.setattr(op12_cells, "CELL_ROWS", 100)
    monkeypatch.setattr(op12_cells, "SAMPLE", 1500)
    monkeypatch.setattr(op12_cells, "BLOCK_BYTES", 64 * 8 * 16)
    monkeypatch.setattr(op12_cells, "AT_ONCE", 1000)
    rng = np.random.default_rng(4)
    centres = rng.normal(size=(20, 16)) * 2
    x = centres[rng.integers(0, 20, 4000)] + rng.normal(size=(4000, 16))
    fitted = []
    real = op12_cells.fit_router
    monkeypatch.setattr(op12_cells, "fit_router", lambda *a: fitted.append(real(*a)) or fitted[-1])
    df = spark.createDataFrame([(i, [float(c) for c in v]) for i, v in enumerate(x)], "vec_id long, embedding array<float>")
    got = lists(op12_cells.nearest(df))
    net = fitted[0]
    assert net.w2.shape[1] == 32 and net.probes < 20  # a part of the cells only
    want = brute_nearest([(r.vec_id, r.embedding) for r in df.collect()])
    hits = sum(len({v for _, v in got[q]} & {v for _, v in want[q]}) for q in want)
    assert hits >= 0.9 * 10 * len(want)
    for q in want:
        exact = {v: s for s, v in brute_nearest([(r.vec_id, r.embedding) for r in df.filter(F.col("vec_id").isin(
            [q, *[v for _, v in got[q]]])).collect()], 99)[q]} if q == 0 else {}
        assert all(exact.get(v, s) == s for s, v in got[q])


def test_balanced_cells():
    rng = np.random.default_rng(6)
    x = rng.normal(size=(600, 8)) + 6 * np.eye(8)[rng.integers(0, 8, 600)]
    graph = op12_cells.neighbour_graph(x, x, 10, True)
    d = ((x[:, None] - x[None]) ** 2).sum(-1)
    np.fill_diagonal(d, np.inf)
    assert all(set(graph[i]) == set(np.argsort(d[i])[:10]) for i in range(0, 600, 37))
    cell, near = op12_cells.balanced_cells(x, graph, 8)
    assert np.bincount(cell, minlength=8).max() <= math.ceil(75 * op12_cells.SLACK)
    kept = near[np.arange(600), cell].sum() / near.sum()
    assert kept > 0.8  # few edges are cut


# --- op13 -------------------------------------------------------------------

def brute_draw(docs, target):
    def features(text):
        w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(UPPER))
        return len(w), [zlib.crc32(f.encode()) % 10000 for f in w + [" ".join(p) for p in zip(w, w[1:], strict=False)]]

    rows = [(i, *features(t)) for i, t in docs]
    s, t = collections.Counter(), collections.Counter()
    for _, _, f in rows:
        s.update(f)
    for x in target:
        t.update(features(x)[1])
    big_s, big_t = sum(s.values()), sum(t.values())
    gain = [math.floor(1000 * math.log((t[b] + 1) * (big_s + 10000) / ((s[b] + 1) * (big_t + 10000)))) for b in range(10000)]
    scored = []
    for i, n, f in rows:
        weight = sum(gain[b] for b in f) // len(f) if f else 0
        h = int(hashlib.sha256(f"7:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        scored.append((i, n, len(f), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))))
    able = sorted((r for r in scored if r[1] >= 20), key=lambda r: (-r[4], r[0] is None, r[0] or 0))
    drawn = able[:25 * len(able) // 100]
    return scored, [(r[0], r[4]) for r in drawn]


def test_draw_equals_brute_force(spark):
    rng = random.Random(8)
    docs = [(i, " ".join(rng.choice(["red", "Blue", "été", "x1", "-", "ß,ß", "q" * rng.choice([3, 60])])
                         for _ in range(rng.randint(0, 90)))) for i in range(200)]
    docs += [(None, "no id " * 30), (300, None), (301, ""), (302, "a " * 70_000), docs[5]]
    target = ["red red blue", None, "", "x1 été"]
    df = spark.createDataFrame([row(*d) for d in docs], SCHEMA)
    tg = spark.createDataFrame([(x,) for x in target], "text string")
    want, drawn = brute_draw(docs, target)
    got = op13_bitsliced.importance_draw(df, tg).collect()
    key = lambda r: (r[0] is None, r[0] or 0, r[1])
    assert sorted(((r.doc_id, r.n_features, r.weight, r.score) for r in got), key=key) == sorted(
        ((i, f, w, s) for i, _, f, w, s in want), key=key)
    assert [(r.doc_id, r.score) for r in sorted((r for r in got if r["rank"]), key=lambda r: r["rank"])] == drawn
    assert sorted(r["rank"] for r in got if r["rank"]) == list(range(1, len(drawn) + 1))
    assert op13_bitsliced.importance_draw(df.limit(0), tg).count() == 0
    assert op13_bitsliced.importance_draw(df, tg.limit(0)).count() == len(docs)


def test_bit_planes_sum_exactly():
    rng = np.random.default_rng(1)
    gains = rng.integers(-20_000, 9_000, op13_bitsliced.BUCKETS)
    gains[:3] = 0
    rows = np.sort(rng.integers(0, 700, 50_000))
    buckets = np.where(rng.random(50_000) < 0.3, 17, rng.integers(0, op13_bitsliced.BUCKETS, 50_000))
    rows[rows == 5] = 6  # a row without features
    got = op13_bitsliced.bit_sliced_sums(rows, buckets, 700, op13_bitsliced.gain_planes(gains))
    want = np.zeros(700, np.int64)
    np.add.at(want, rows, gains[buckets])
    assert (got == want).all() and got[5] == 0


# --- earlier operators ----------------------------------------------------------

def test_weights_noise_and_choice_of_op3(spark):
    """Every weight, noise and choice from plain loops over the hashed n-grams."""
    got = {r.doc_id: r for r in QUERIES["op3_importance"](spark, SF_SMALL).collect()}
    con = duckdb.connect()
    docs = con.execute(f"SELECT doc_id, text FROM '{SF_SMALL}/documents.parquet'").fetchall()
    labels = con.execute(f"SELECT doc_id, quality, toxic FROM '{SF_SMALL}/labels.parquet'").fetchall()
    import pyarrow as pa
    grams = {}
    for i, text in docs:
        for _, _, buf, offs in text_slices(pa.array([text])):
            grams[i] = op3_resample.ngram_buckets(buf, offs)[1].tolist()
    target = {i for i, q, t in labels if q == 1 and not t and i is not None}
    raw, hit = collections.Counter(), collections.Counter()
    for i, g in grams.items():
        raw.update(g)
        if i in target:
            hit.update(g)
    total, in_target = sum(raw.values()), sum(hit.values())
    prior = op3_resample.PRIOR
    ratio = {b: math.log(((hit[b] + prior * raw[b] / total) / (in_target + prior)) / (raw[b] / total)) for b in raw}
    hashes = {r.doc_id: r.h for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet")
              .select("doc_id", F.xxhash64("text").alias("h")).collect()}
    for i, g in grams.items():
        assert got[i].n_grams == len(g)
        assert got[i].log_weight == pytest.approx(sum(ratio[b] for b in g), abs=1e-6)
        key = op3_resample.mix(np.array([i], np.int64).view(np.uint64)) ^ np.array([hashes[i]], np.int64).view(np.uint64)
        u = int(op3_resample.mix(key ^ np.uint64(op3_resample.SEED))[0]) >> 11
        assert got[i].noisy == pytest.approx(got[i].log_weight - math.log(-math.log((u + 0.5) / 2 ** 53)), abs=1e-6)
    known = [(q, t) for _, q, t in labels if q is not None]
    k = round(sum(q == 1 for q, _ in known) / len(known) * len(docs))
    best = sorted(got.values(), key=lambda r: -r.noisy)[:k]
    assert {r.doc_id for r in got.values() if r.kept} == {r.doc_id for r in best}


FRAME = [f"frame{i} one{i} two{i} three{i}" for i in range(60)]


def framed(n=200):
    return [(d, "\n".join([*FRAME, *[f"own{d}x{i} a{d}b{i} c{d}d{i}" for i in range(9)]])) for d in range(n)]


def test_sql_of_line_frequency_counts_documents(spark):
    """A host whose pages share many frame lines: code and SQL remove them all."""
    rows = framed()
    docs = spark.createDataFrame([row(i, t) for i, t in rows], SCHEMA)
    got = op6_quality.quality(docs).select("doc_id", "n_words", "n_removed_words", "kept").collect()
    con = duckdb.connect()
    con.execute("CREATE TABLE documents(doc_id BIGINT, text VARCHAR, source VARCHAR)")
    con.executemany("INSERT INTO documents VALUES (?, ?, 's')", rows)
    want = con.execute(f"SELECT doc_id, n_words, n_removed_words, kept FROM ({op6_quality.ORACLE})").fetchall()
    assert sorted(map(tuple, got)) == sorted(want)
    assert all(r.n_removed_words == 240 for r in got)


def test_cuts_are_linear_in_the_lines(spark):
    """20 documents of 5,000 lines, a fifth of them frequent, and two of 10,000 repeated ones."""
    n = 5000
    frame = [f"frame line{i} x{i} y{i}" for i in range(n // 5)]
    rows = []
    for d in range(20):
        own = [f"own{d}a{i} own{d}b{i} own{d}c{i} own{d}d{i}" for i in range(n - n // 5)]
        rows.append(row(d, "\n".join(x for k in range(len(frame)) for x in (frame[k], *own[4 * k:4 * k + 4]))))
    docs = spark.createDataFrame(rows, SCHEMA)
    op6_quality.apply_rules(docs.limit(1)).collect()  # compiled
    t = time.time()
    out = op6_quality.apply_rules(docs).collect()
    assert time.time() - t < 30  # seconds on this machine: about 5
    assert len(out) == 20 and all("frame" not in r.text and r.text.count("\n") == n - n // 5 - 1 for r in out)
    text = "\n".join(f"same{i} line" for i in range(10_000))
    t = time.time()
    got = op4_lines.dedup_lines(spark.createDataFrame([row(1, text), row(2, text + "\nown\n")], SCHEMA)).collect()
    assert time.time() - t < 30
    assert sorted((r.doc_id, r.text == text if r.doc_id == 1 else r.text) for r in got) == [(1, True), (2, "own\n")]


def test_pipeline_loses_no_text(spark):
    """Rows that repeat an id are documents of their own; of each group one stays."""
    x, y = (" ".join(f"{c}{i}" for i in range(60)) for c in "xy")

    def go(rows):
        docs = spark.createDataFrame([row(i, t, s) for i, t, s in rows], SCHEMA)
        return sorted(((r.doc_id, r.text, r.source) for r in corpus_pipeline.near_dedup(spark, docs, SF_SMALL).collect()),
                      key=repr)

    assert go([(1, x, "a"), (5, x, "b"), (5, y, "c")]) == [(1, x, "a"), (5, y, "c")]
    assert go([(1, x, "b"), (1, x, "a"), (2, x + " tail", "z"), (3, y, "q")]) == [(1, x, "a"), (3, y, "q")]
    assert len(go([(5, x + " tail", "m"), (5, x, "k"), (6, y, "o"), (6, y, "o")])) == 2
    assert go([(7, None, "e"), (8, "", "e"), (8, "", "e")]) == [(7, None, "e"), (8, "", "e"), (8, "", "e")]
    assert len(go([(None, x, "n"), (None, x, "n"), (1, x, "a")])) == 3


@pytest.mark.parametrize(("page", "want"), [
    ('<ul><li class="nav-item">Home<li>Other</ul><article><p>Text</p></article>', ["Text"]),
    ('<table><tr><td class="sidebar">Menu<td><article>Text</article></table>', ["Text"]),
    ('<nav><a href="/">Home</a><article><h1>Title</h1>Text</article>', ["Title", "Text"]),
    ('<article><section id="share"><p>Share prices fell.</p></section>Text</article>', ["Share prices fell.", "Text"]),
    ('<article><div class="related-work">Others found the same.</div>Text</article>', ["Others found the same.", "Text"]),
    ('<form id="page"><article><p>Text</article></form>', ["Text"]),
    ('<div><div class="sidebar"><p>Side</div><p>One<p>Two</div><footer>f', ["One", "Two"]),
    ('<header><nav>Menu</header><main><p>Text<aside>Note</aside> more</main>', ["Text", "more"]),
    ('<article>Text<div class="share-buttons">Tweet</div><section id="comments"><article class="c">No</article></section></article>',
     ["Text"]),
    ('<article>Text<div class="ad">Buy<p>now</div><p>Rest</article><aside><article>Teaser</article></aside>', ["Text", "Rest"]),
    ('<body><p class="cookie">Cookies</p><dl><dt class="menu">m<dd>Text</dl></body>after', ["Text", "after"]),
    ('<p>a <b>bold</i> c</b><div>d</span>e</div></nav>f', ["a bold c", "de", "f"]), ('a <button>no</button>b', ["a b"]),
    ('<select><option>x<option>y</select><p>Text', ["Text"]),
    ("", []), ("<", ["<"]), ("<article></article><p>out", []),
])
def test_left_out_elements_end(page, want):
    assert op9_html.page_lines(page)[0] == want


def test_pages_without_end_tags(spark):
    """The given pages, with the end tags that HTML lets one leave out taken away, give the same text."""
    pages = spark.read.parquet(f"{SF_SMALL}/pages.parquet").collect()
    optional = re.compile(r"</(?:p|li|td|tr|dd|dt|option|body|html)>")
    n = 0
    for r in pages:
        bare = optional.sub("", r.html)
        n += bare != r.html
        assert op9_html.page_lines(bare) == op9_html.page_lines(r.html)
    assert n > 10


def test_expectation_maximisation_equals_item_by_item():
    """Reliabilities and probabilities from every single item, by plain arrays."""
    rng = np.random.default_rng(12)
    truth = rng.random(3000) < 0.2
    votes = np.zeros((3000, op8_pii.N_VOTERS), int)
    for k in range(op8_pii.N_VOTERS):
        casts, right = rng.random(3000) < 0.5 + 0.05 * k, rng.random(3000) < 0.7 + 0.04 * k
        votes[:, k] = np.where(casts, np.where(right == truth, 1, -1), 0)
    code = ((votes + 1) * 3 ** np.arange(op8_pii.N_VOTERS)).sum(axis=1)
    got = op8_pii.expectation_maximisation(dict(collections.Counter(code.tolist())))
    s = votes.sum(axis=1)
    p = np.where(s > 0, 0.9, np.where(s < 0, 0.1, 0.5))
    for _ in range(60):
        share = (1 + p.sum()) / (2 + len(p))
        z = np.full(len(p), math.log(share / (1 - share)))
        for k in range(op8_pii.N_VOTERS):
            for v in (-1, 0, 1):
                here = votes[:, k] == v
                yes, no = (1 + p[here].sum()) / (3 + p.sum()), (1 + (1 - p)[here].sum()) / (3 + (1 - p).sum())
                z[here] += math.log(yes / no)
        new = 1 / (1 + np.exp(-z))
        done = np.abs(new - p).max() < 1e-9
        p = new
        if done:
            break
    assert np.allclose([got[c] for c in code.tolist()], p, atol=1e-6)
    assert ((p > 0.5) == truth).mean() > 0.95


def test_learned_spans_equal_brute_force(spark):
    """The whole learned part on a small table: votes, EM, soft counts, classifier, decisions."""
    docs = duckdb.connect().execute("SELECT doc_id, text FROM '/root/testdata/sf0.01/documents.parquet'").fetchall()
    found = {i: list(op8_pii.candidates(t or "", op8_pii.base_spans(t or ""))) for i, t in docs}
    prob = op8_pii.expectation_maximisation(dict(collections.Counter(c[2] for f in found.values() for c in f)))
    pos, every = collections.Counter(), collections.Counter()
    for f in found.values():
        for _, _, pattern, features in f:
            for x in (-1, *features):
                pos[x] += prob[pattern]
                every[x] += 1
    total, rest = pos[-1] + 1, every[-1] - pos[-1] + 1
    weight = {x: math.log((pos[x] + 1) / (total + 16)) - math.log((every[x] - pos[x] + 1) / (rest + 16)) for x in every}
    want = {i: sorted((s, e) for s, e, _, fs in f if math.log(total / rest) + sum(weight[x] for x in fs) > 0)
            for i, f in found.items()}
    got = {r.doc_id: [(x.s, x.e) for x in r.span_list if x.kind == "secret"] for r in op8_pii.find_pii(
        spark.read.parquet("/root/testdata/sf0.01/documents.parquet")).collect()}
    assert got == want and sum(map(len, want.values())) > 10


def test_a_contained_passage_with_another_partner_stays(spark):
    """Documents 1 and 2 share 120 words, 2 and 3 the middle 60 of them: every document has a row."""
    from sluice.llm.op10_chains import fuzzy_passages
    rng = random.Random(21)
    fresh = lambda n: [f"v{rng.randrange(10 ** 9)}" for _ in range(n)]
    long = fresh(120)
    rows = [(1, fresh(30) + long + fresh(30)), (2, fresh(40) + long + fresh(20)), (3, fresh(25) + long[30:90] + fresh(25))]
    df = spark.createDataFrame([row(i, " ".join(w)) for i, w in rows], SCHEMA)
    got = fuzzy_passages(df).collect()
    assert {r.doc_id for r in got} | {r.other_doc_id for r in got} == {1, 2, 3}


def test_names_and_numbers_are_learned(spark):
    """Titles, labels, given names, formats and check digits vote; the classifier takes persons and numbers, not their look-alikes."""
    rng = random.Random(31)
    family = ["Smith", "Müller", "Dupont", "García", "O'Brien", "Weiß", "Novak", "Rossi"]
    rows, want = [], {}
    for i in range(300):
        filler = " ".join(rng.choice(["alpha", "beta", "gamma", "delta"]) for _ in range(8))
        kind = i % 6
        if kind == 0:
            hit, text = f"{rng.choice(['John', 'Anna', 'Klaus'])} {rng.choice(family)}", f"{filler} {{}} {filler}"
        elif kind == 1:
            hit, text = f"{rng.choice(['Ellen', 'Tom'])} {rng.choice(family)}", f"{filler} {rng.choice(['Mr. ', 'Frau ', 'Mme '])}{{}}, {filler}"
        elif kind == 2:
            hit, text = f"{rng.randrange(100, 600)}-{rng.randrange(10, 99)}-{rng.randrange(1000, 9999)}", f"{filler} ssn: {{}} {filler}"
        elif kind == 3:
            bank = "".join(str(rng.randrange(10)) for _ in range(18))
            check = 98 - int("".join(str(int(c, 36)) for c in bank + "DE00")) % 97
            hit = f"DE{check:02d}{bank}"
            text = f"{filler} account {{}} {filler}"
        elif kind == 4:
            hit, text = None, f"The Name of the rose. {filler}. And The This. Dr. {filler}"
        else:
            hit, text = None, f"{filler} 000-00-0000 and 666-00-{rng.randrange(1000, 9999)} {filler}"
        text = text.format(hit)
        rows.append((i, text))
        want[i] = (("name" if kind < 2 else "id"), text.index(hit), text.index(hit) + len(hit)) if hit else None
    docs = spark.createDataFrame([row(*r) for r in rows], SCHEMA)
    got = {r.doc_id: r for r in op8_pii.find_pii(docs).collect()}
    for i, hit in want.items():
        found = [(x.kind, x.s, x.e) for x in got[i].span_list if x.kind in ("name", "id")]
        assert found == ([hit] if hit else []), (rows[i], found)
        assert (got[i].n_name, got[i].n_id) == (int(bool(hit) and hit[0] == "name"), int(bool(hit) and hit[0] == "id"))
    masked = {r.doc_id: r.text for r in op8_pii.mask_pii(docs).collect()}
    assert "<NAME>" in masked[0] and rows[0][1][want[0][1]:want[0][2]] not in masked[0]
