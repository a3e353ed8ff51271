"""Operators against brute force, exact round trips, DuckDB and held-out labels."""

import collections
import itertools
import math
import random
import re

import duckdb
import numpy as np
import pyarrow as pa
import pytest

import corpus_pipeline
from sluice.llm import op1_search, op5_packing, op6_quality, op7_pieces, op8_pii, op9_html, op10_chains
from sluice.llm.op2_minhash import least_matches
from sluice.llm.op3_resample import kth_largest
from sluice.llm.queries import ORACLE, QUERIES
from tests.conftest import SF_SMALL

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def words(text):
    return WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def shingles(text):
    w = words(text)
    return frozenset(tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))) if w else frozenset()


def find(parent, x):
    while parent[x] != x:
        x = parent[x]
    return x


def brute_components(rows):
    sets = {i: shingles(t) for i, t in rows}
    parent = {i: i for i in sets}
    for a, b in itertools.combinations(sorted(sets), 2):
        both = len(sets[a] & sets[b])
        if both and 100 * both >= 75 * (len(sets[a]) + len(sets[b]) - both):
            x, y = find(parent, a), find(parent, b)
            parent[max(x, y)] = min(x, y)
    return {i: (len(sets[i]), find(parent, i)) for i in sets}


@pytest.fixture(scope="module")
def small_docs():
    return duckdb.sql(f"SELECT doc_id, text FROM '{SF_SMALL}/documents.parquet'").fetchall()


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_oracle(spark, name):
    con = duckdb.connect()
    for t in ("documents", "labels", "pages", "benchmark"):
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{SF_SMALL}/{t}.parquet'")
    df = QUERIES[name](spark, SF_SMALL)
    cols = sorted(df.columns)
    want = con.sql(f"SELECT {', '.join(cols)} FROM ({ORACLE[name]})").fetchall()
    assert sorted(map(tuple, df.select(cols).collect()), key=repr) == sorted(want, key=repr)


def test_near_duplicates(spark, small_docs):
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in QUERIES["op2_minhash_bayes"](spark, SF_SMALL).collect()}
    assert got == brute_components(small_docs)


def test_near_duplicates_without_a_centre(spark):
    """A chain of copies, each linked with its neighbours only, and docs that share a passage."""
    from sluice.llm.op2_minhash import near_duplicates
    rng = random.Random(1)
    base = [f"b{i}" for i in range(400)]
    rows = [(i, " ".join(base[20 * i:20 * i + 200] + [f"z{i}-{k}" for k in range(2)])) for i in range(10)]
    passage = [f"p{i}" for i in range(120)]
    rows += [(100 + i, " ".join(passage + [f"q{rng.random()}" for _ in range(60)])) for i in range(40)]
    got = {r.doc_id: (r.n_shingles, r.component_id)
           for r in near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    want = brute_components(rows)
    assert got == want and len({want[i][1] for i in range(10)}) == 1


def test_least_matches_bounds_the_posterior():
    rng = np.random.default_rng(0)
    hits = rng.binomial(400, 0.75 + 0.25 / 256, 20_000)
    assert (hits < least_matches(400, 0.75, 1e-4)).mean() < 1e-3
    assert least_matches(400, 0.75, 1e-4) > 250


def test_kth_largest(spark):
    rng = np.random.default_rng(3)
    values = [int(x) for x in rng.integers(-2**63, 2**63 - 1, 500)] + [7] * 20
    df = spark.createDataFrame([(v,) for v in values], "v long")
    ranked = sorted(values, reverse=True)
    for k in (1, 2, 250, 260, 519, 520):
        assert kth_largest(df, "v", k) == ranked[k - 1]
    assert kth_largest(df, "v", 521) is None and kth_largest(df, "v", 0) is None


def test_resampling_keeps_clean_text(spark):
    got = {r.doc_id: r for r in QUERIES["op3_importance"](spark, "/root/testdata/sf0.01").collect()}
    labels = duckdb.sql("SELECT doc_id, quality FROM '/root/testdata/sf0.01/labels.parquet'").fetchall()
    good = [got[i].kept for i, q in labels if q == 1]
    junk = [got[i].kept for i, q in labels if q == 0]
    assert sum(good) / len(good) > 0.9 and sum(junk) / len(junk) < 0.5


def test_line_frequency_of_hosts_with_many_frame_lines(spark):
    """Lines in all documents of a host go, however many there are; exact copies have one vote."""
    rng = random.Random(31)
    frame = [f"frame line {k} of the site with its menu" for k in range(60)]
    rows = []
    for i in range(200):
        own = [f"own line {i}-{k} with a few words" for k in range(1 + i % 4)]
        at = rng.randrange(61)
        rows.append((i, "\n".join(frame[:at] + own + frame[at:]), "framed"))
    article = "\n".join(f"article line {k} with words {k * 7} and {k * 11}" for k in range(10))
    rows += [(1000 + i, article, "copies") for i in range(40)]
    rows += [(2000 + i, "\n".join(f"body {i} line {k} with words {k * 3}" for k in range(10)), "copies") for i in range(60)]
    got = {r.doc_id: r for r in op6_quality.quality(
        spark.createDataFrame(rows, "doc_id long, text string, source string")).collect()}
    by_line = collections.defaultdict(set)
    for i, t, host in rows:
        for x in t.split("\n"):
            by_line[host, x].add(t)
    sizes = {h: len({t for _, t, k in rows if k == h}) for h in ("framed", "copies")}
    for i, t, host in rows:
        n = {x: len(by_line[host, x]) for x in t.split("\n")}
        want = [k for k, x in enumerate(t.split("\n")) if n[x] >= 10 and 10 * n[x] > sizes[host]]
        assert got[i].removed_lines == want
        assert got[i].kept == (host == "copies")


def naive_best_fit(sizes, sources, clusters, capacity):
    shared = collections.Counter(clusters)
    bins, out = [], []
    for s, a, c in zip(sizes, sources, clusters):
        fits = [(b["room"], k) for k, b in enumerate(bins)
                if b["room"] >= s and a not in b["a"] and not (shared[c] > 1 and c in b["c"])]
        k = min(fits)[1] if fits else len(bins)
        if not fits:
            bins.append({"room": capacity, "a": set(), "c": set()})
        bins[k]["room"] -= s
        bins[k]["a"].add(a)
        bins[k]["c"].add(c)
        out.append(k)
    return out, len(bins)


@pytest.mark.parametrize("seed", range(20))
def test_best_fit(seed):
    rng = random.Random(seed)
    n, cap = rng.randrange(1, 300), rng.choice([7, 32, 100])
    sizes = sorted((rng.randrange(1, cap) for _ in range(n)), reverse=True)
    sources = [rng.choice("aaabcdefgh") for _ in range(n)]
    clusters = [rng.randrange(max(1, n // 3)) for _ in range(n)]
    assert op5_packing.best_fit(sizes, sources, clusters, cap) == naive_best_fit(sizes, sources, clusters, cap)


def test_pieces_match_the_library(small_docs):
    import sentencepiece
    sp = sentencepiece.SentencePieceProcessor(model_file=op7_pieces.MODEL)
    pieces = op7_pieces.load_pieces()
    plain = op7_pieces.Sampler(pieces, 0.0, 1)
    dropped, again, other = (op7_pieces.Sampler(pieces, 0.3, seed) for seed in (1, 1, 2))
    texts = [t for _, t in small_docs][:60] + ["  lead", " ", "\n", "a  b\n\n c", "ü😀 \x00 \x7f", "x" * 500]
    differs = 0
    for k, t in enumerate([*texts, "mark ▁ in ▁▁text", "▁"]):
        own = plain.encode_all([t], [k])[0]
        if "▁" not in t:
            assert list(own) == sp.encode(t)
        ids = dropped.encode_all([t], [k])[0]
        assert op7_pieces.decode_ids(ids, pieces) == t
        assert list(ids) == list(again.encode_all([t], [k])[0])
        differs += list(ids) != list(other.encode_all([t], [k])[0]) and len(ids) >= len(own)
    assert differs > 50


def test_decoding_of_any_ids():
    """Runs of byte pieces that make no character become replacement marks, up to the next piece."""
    pieces = op7_pieces.load_pieces()
    rng = random.Random(4)
    some = [rng.randrange(len(pieces.texts)) for _ in range(50)] + pieces.byte_ids
    for _ in range(300):
        ids = [rng.choice(some) for _ in range(rng.randrange(30))]
        want, run = "", b""
        for i in [*ids, None]:
            if i in pieces.byte_of:
                run += bytes([pieces.byte_of[i]])
                continue
            want, run = want + run.decode("utf-8", "replace"), b""
            want += pieces.texts[i].replace("▁", " ") if i is not None else ""
        assert op7_pieces.decode_ids(ids, pieces) == want[1:]


def test_dropout_is_drawn_per_occurrence(small_docs):
    """Every occurrence has the pieces of its own agenda; those of a word vary as with keys drawn by themselves."""
    pieces = op7_pieces.load_pieces()
    texts = [t for _, t in small_docs][:20] + ["  lead", "\n", "a  b\n\n c", "ü😀 \x00 \x7f", "x" * 500, "▁ in ▁▁text", ""]
    for dropout in (0.0, 0.1, 0.5):
        sampler = op7_pieces.Sampler(pieces, dropout, 3)
        for got, (k, t) in zip(sampler.encode_all(texts, list(range(len(texts)))), enumerate(texts), strict=True):
            chunks = pieces.chunk.findall(" " + t) if t else []
            keys = sampler._keys(len(chunks), k).tolist()
            assert got.tolist() == [x for c, key in zip(chunks, keys, strict=True)
                                    for x in op7_pieces.encode_chunk(c, pieces, key, dropout)]
            assert op7_pieces.decode_ids(got, pieces) == t
    word = " information"
    text = (word * 5000)[1:]
    (batch,) = op7_pieces._encode(pieces, 0.1, 9)(iter([pa.RecordBatch.from_arrays(
        [pa.array([5]), pa.array([text])], names=["doc_id", "text"])]))
    ids = batch.column("ids")[0].as_py()
    segmentations, at = collections.Counter(), 0
    while at < len(ids):
        end, spelt = at, ""
        while len(spelt) < len(word):
            spelt += pieces.texts[ids[end]]
            end += 1
        segmentations[tuple(ids[at:end])] += 1
        at = end
    assert sum(segmentations.values()) == 5000 and len(segmentations) > 8
    rng = random.Random(2)
    want = collections.Counter(tuple(op7_pieces.encode_chunk(word, pieces, rng.getrandbits(64), 0.1)) for _ in range(5000))
    assert all(abs(segmentations[x] - n) < 150 for x, n in want.items())


EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def luhn(d):
    d = [int(c) for c in d][::-1]
    return sum(d[0::2] + [sum(divmod(2 * x, 10)) for x in d[1::2]]) % 10 == 0


def brute_spans(t):
    out = [("email", *m.span()) for m in EMAIL.finditer(t)]
    out += [("ip", *m.span()) for m in IP.finditer(t) if all(int(p) <= 255 for p in m.group().split("."))]
    for m in CARD.finditer(t):
        d = re.sub("[^0-9]", "", m.group())
        if 13 <= len(d) <= 19 and luhn(d):
            out.append(("card", *m.span()))
    out += [("phone", *m.span()) for m in PHONE.finditer(t) if 9 <= len(re.findall("[0-9]", m.group())) <= 15]
    return out


def test_base_spans(small_docs):
    rng = random.Random(2)
    texts = [t for _, t in small_docs]
    for alphabet in ("a@.b-", "0123.5 ", "12 -+()", "a@b.1+2 9é"):
        texts += ["".join(rng.choice(alphabet) for _ in range(rng.randrange(60))) for _ in range(3000)]
    texts += ["4111 1111 1111 1111", "a@b.c@d.e", "1.2.3.4.5.6.7.8", "001.2.3.255", "x@y.z.", "%%@-.-"]
    for t in texts:
        assert op8_pii.base_spans(t) == brute_spans(t), t


def test_secrets_are_found(spark):
    rows = duckdb.sql("SELECT doc_id, text FROM '/root/testdata/sf0.01/documents.parquet'").fetchall()
    want = {(i, *m.span(k)) for i, t in rows
            for m in re.finditer(r"password=([0-9a-f]+)|token = \"([0-9a-f]+)|(AKIA[A-Z0-9]{16})", t)
            for k in (1, 2, 3) if m.group(k)}
    got = {(r.doc_id, s["s"], s["e"]) for r in op8_pii.find_pii(
        spark.read.parquet("/root/testdata/sf0.01/documents.parquet")).collect() for s in r.span_list
        if s["kind"] == "secret"}
    assert len(want & got) >= 0.95 * len(want) and len(got - want) <= 0.05 * len(got)


def brute_lcs(a, b):
    t = np.zeros((len(a) + 1, len(b) + 1), int)
    for i, j in itertools.product(range(len(a)), range(len(b))):
        t[i + 1, j + 1] = t[i, j] + 1 if a[i] == b[j] else max(t[i, j + 1], t[i + 1, j])
    return t[-1, -1]


def test_common_lines():
    rng = random.Random(4)
    for _ in range(300):
        a, b = ([rng.randrange(6) for _ in range(rng.randrange(12))] for _ in range(2))
        pairs = op9_html.common_lines(a, b)
        assert len(pairs) == brute_lcs(a, b)
        assert all(a[i] == b[j] for i, j in pairs)
        assert all(p[0] < q[0] and p[1] < q[1] for p, q in itertools.pairwise(pairs))


def test_page_markup():
    page = """<!DOCTYPE html><html><head><title>T &lt;p&gt;</title><style>p{}</style><script>var x="<p>no</p>"</script></head>
    <body class="ad-free sidebar"><header><h1>Site</h1></header><nav><ul><li>Menu</li></ul></nav>
    <div class="cookie-notice">We use <p>cookies</p></div><!-- <p>gone</p> -->
    <main><article><h1>Head&nbsp;line</h1><p>One <b>two</b>&amp;three<br>four<p>caf&eacute; &#8364;
    <aside>side</aside><form><p>f</p></form><div class='ad'>buy <div>now</div></div><blockquote>q</blockquote>
    <div id="comments"><p>first!</p></div></article></main><footer>(c)</footer></body></html>"""
    assert op9_html.page_lines(page) == (["Head line", "One two&three four", "café €", "q"], True)
    assert op9_html.page_lines("a < b <p>c</p") == (["a < b", "c"], False)
    assert op9_html.page_lines("<article>x<artic") == (["x"], True)


def test_page_differencing(spark):
    frame = ["Site name", "Menu one", "All rights reserved"]
    rows = [(i, f"http://h.org/{i:02d}", "".join(f"<div>{x}</div>" for x in
             [*frame[:2], *[f"story {i} line {k} with some words" for k in range(4)], frame[2]]))
            for i in range(30)]
    rows.append((99, "http://h.org/99-copy", rows[-1][2]))  # a copy of its neighbour: nothing to learn
    got = {r.page_id: r.text for r in op9_html.main_text(
        spark.createDataFrame(rows, "page_id long, url string, html string").repartition(5)).collect()}
    for i in range(29):
        assert got[i] == "\n".join(f"story {i} line {k} with some words" for k in range(4))
    assert "Site name" in got[99]


def test_fuzzy_passages(spark):
    rng = random.Random(9)
    vocab = [f"v{i}" for i in range(3000)]

    def text(n):
        return [rng.choice(vocab) for _ in range(n)]

    passages = [text(80) for _ in range(3)]
    rows, planted = [], {}
    for i in range(40):
        body = text(rng.randrange(20, 300))
        if i % 4 == 0:
            k = i // 4 % 3
            p = list(passages[k])
            # An edit, an insertion and a deletion, which leave a run of
            # K + 2 * WINNOW words, as the operator asks for.
            p[rng.randrange(80 - op10_chains.K - 2 * op10_chains.WINNOW)] = "edited"
            p.insert(rng.randrange(50), "more")
            del p[rng.randrange(50)]
            at = rng.randrange(len(body))
            body[at:at] = p
            planted[i] = (k, at, at + len(p))
        rows.append((i, " ".join(body)))
    got = op10_chains.fuzzy_passages(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    found = collections.defaultdict(set)
    for r in got:
        assert planted[r.doc_id][0] == planted[r.other_doc_id][0]
        _, s, e = planted[r.doc_id]
        assert min(e, r.end_word) - max(s, r.start_word) >= 50
        found[planted[r.doc_id][0]] |= {r.doc_id, r.other_doc_id}
    for k in range(3):
        assert found[k] == {i for i in planted if planted[i][0] == k}


def shared_passages(a, b, min_words=50, min_identity=80):
    """``passages`` of two word lists."""
    texts = [" ".join(x) for x in (a, b)]
    rows = [r[1:] for r in op10_chains._row_runs(pa.array(texts))]
    return op10_chains.passages(*rows[0], *rows[1], min_words, min_identity)


@pytest.mark.parametrize("gap", [0, 10, 30, 55, 100, 300, 600])
@pytest.mark.parametrize("first", [6, 12, 60])
def test_every_passage_of_a_pair(gap, first):
    """Two passages, or a stray match ahead of one, with unlike words between and around them."""
    x, y = [f"x{i}" for i in range(first)], [f"y{i}" for i in range(60)]
    docs = [[f"{d}{i}" for i in range(40)] + x + [f"{d}-{i}" for i in range(gap)] + y + [f"{d}_{i}" for i in range(40)]
            for d in "ab"]
    got = shared_passages(*docs)
    covered = {i for s, e, _, _, _ in got for i in range(s, e)}
    want = set(range(40 + first + gap, 100 + first + gap)) | (set(range(40, 40 + first)) if first >= 50 else set())
    assert want <= covered
    for s, e, t, u, n in got:
        equal = sum(v == w for v, w in zip(docs[0][s:e], docs[1][t:u], strict=True))
        assert n == equal and e - s >= 50 and 100 * n >= 80 * (e - s)


def test_passages_of_many_pieces():
    """Random passages with edits, in one order in both texts: each is found, whatever lies between."""
    rng = random.Random(17)
    for trial in range(40):
        docs, want, k = [[], []], [], 0
        for part in range(rng.randrange(2, 6)):
            for d in (0, 1):
                docs[d] += [f"u{trial}-{part}-{d}-{i}" for i in range(rng.randrange(150))]
            p = [f"p{part}-{i}" for i in range(rng.choice([6, 9, 60, 90]))]
            q = list(p)
            for i in range(15, len(q), 15) if len(q) >= 60 else ():
                q[i] = f"edit{k}"
                k += 1
            if len(p) >= 60:
                want.append((len(docs[0]), len(docs[0]) + len(p)))
            docs[0] += p
            docs[1] += q
        got = shared_passages(*docs)
        for s, e in want:
            assert any(min(e, g[1]) - max(s, g[0]) >= 50 for g in got), (trial, s, e, got)


@pytest.mark.parametrize("size,edits,least", [(60, 6, 0.98), (60, 9, 0.98), (60, 12, 0.9), (100, 15, 0.98),
                                              (100, 20, 0.95), (60, "every 10th", 0.98), (60, "every 12th", 0.98)])
def test_edited_passages_are_candidates(size, edits, least):
    """Passages of 80 to 92 % equal words share a link key, wherever the edits fall."""
    rng = random.Random(23)
    met = 0
    for trial in range(100):
        p = [f"p{trial}-{rng.random()}" for _ in range(size)]
        q = list(p)
        for i in (rng.sample(range(size), edits) if isinstance(edits, int)
                  else range(int(edits[6:8]) - 1, size, int(edits[6:8]))):
            q[i] = f"e{rng.random()}"
        texts = [" ".join([f"{d}{rng.random()}" for _ in range(50)] + x + [f"{d}{rng.random()}" for _ in range(50)])
                 for d, x in (("a", p), ("b", q))]
        batch = pa.RecordBatch.from_arrays([pa.array([1, 2]), pa.array(texts)], names=["doc_id", "text"])
        keys = collections.Counter(next(op10_chains._keys(iter([batch]))).column("key").to_pylist())
        met += max(keys.values()) > 1
    assert met >= least * 100


def test_fuzzy_passages_with_edits_anywhere(spark):
    """As test_fuzzy_passages, with the edits anywhere in the passage."""
    rng = random.Random(9)
    rows, planted = [], {}
    for k in range(10):
        p = [f"p{k}-{i}" for i in range(80)]
        for i in (2 * k, 2 * k + 1):
            q = list(p)
            if i % 2:
                for j in rng.sample(range(80), 4):
                    q[j] = "edited"
                q.insert(rng.randrange(80), "more")
                del q[rng.randrange(80)]
            body = [f"b{i}-{j}" for j in range(rng.randrange(20, 300))]
            at = rng.randrange(len(body))
            rows.append((i, " ".join(body[:at] + q + body[at:])))
            planted[i] = (at, at + len(q))
    got = op10_chains.fuzzy_passages(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    found = set()
    for r in got:
        assert r.doc_id // 2 == r.other_doc_id // 2
        s, e = planted[r.doc_id]
        assert min(e, r.end_word) - max(s, r.start_word) >= 50
        found.add(r.doc_id // 2)
    assert found == set(range(10))


def test_chain_scores():
    """The Fenwick form against the quadratic one."""
    rng = random.Random(11)
    c, k = op10_chains.GAP_COST, op10_chains.K
    for _ in range(100):
        n = rng.randrange(1, 30)
        a = np.array(sorted(rng.randrange(200) for _ in range(n)))
        b = np.array([rng.randrange(200) for _ in range(n)])
        size = np.array([rng.randrange(k, 30) for _ in range(n)])
        ea, eb = a + size - k + 1, b + size - k + 1
        best = [0.0] * n
        for i in range(n):
            best[i] = size[i] + max([0.0] + [
                best[j] - c * (a[i] - ea[j] + b[i] - eb[j]) for j in range(n) if ea[j] <= a[i] and eb[j] <= b[i]])
        top = op10_chains.chains(a, b, size)[0]
        got = size[top].sum() - c * sum(a[j] - ea[i] + b[j] - eb[i] for i, j in itertools.pairwise(top))
        assert abs(got - max(best)) < 1e-6
        assert sorted(np.concatenate(op10_chains.chains(a, b, size)).tolist()) == list(range(n))


def test_segments():
    rng = np.random.default_rng(5)
    x = rng.integers(0, 2**62, 100).astype(np.uint64)
    a, b, size = op10_chains.segments(x, np.concatenate([x[50:], x[:50]]))
    assert (a.tolist(), b.tolist(), size.tolist()) == (
        [0, 50], [50, 0], [50 + op10_chains.K - 1] * 2)
    same = np.zeros(300, np.uint64)
    a, b, size = op10_chains.segments(same, same[:100])
    assert len(a) == 201 and size[0] == 100 + op10_chains.K - 1  # linear, not 300 * 100


def test_extension_is_the_best_end():
    rng = np.random.default_rng(1)
    for _ in range(200):
        x = rng.integers(0, 2, rng.integers(0, 900))
        n, equal = op10_chains._extend(x, np.zeros(len(x), int))
        score, best, at = 0, 0, 0
        for k, v in enumerate(x):
            score += 1 if v == 0 else -2
            if best - score > op10_chains.XDROP:
                break
            if score > best:
                best, at = score, k + 1
        assert (n, equal) == (at, int((x[:at] == 0).sum()))


def windows_of(text):
    lines = [x for x in text.split("\n") if WORD.search(x)]
    return [tuple(lines[i:i + 3]) for i in range(len(lines) - 2)]


def test_pipeline(spark):
    """Every stage of the pipeline against brute force, on the stage's own input."""
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    tables = [docs]
    for _, stage in corpus_pipeline.STAGES:
        out = stage(spark, tables[-1], SF_SMALL)
        tables.append(spark.createDataFrame(out.collect(), out.schema))
    start, ruled, lined, single, masked, packed = [t.collect() for t in tables]
    verdict = QUERIES["op6_line_frequency"](spark, SF_SMALL).filter("kept").select("doc_id").collect()
    assert {r.doc_id for r in ruled} == {r.doc_id for r in verdict}
    seen, text = set(), {r.doc_id: r.text for r in lined}
    assert set(text) == {r.doc_id for r in ruled}
    for r in sorted(ruled, key=lambda r: r.doc_id):
        lines = r.text.split("\n")
        full = [k for k, x in enumerate(lines) if WORD.search(x)]
        cut = set()
        for i in range(len(full) - 2):
            w = tuple(lines[k] for k in full[i:i + 3])
            if w in seen:
                cut |= set(full[i:i + 3])
            seen.add(w)
        assert text[r.doc_id] == "\n".join(x for k, x in enumerate(lines) if k not in cut)
    groups = brute_components([(r.doc_id, r.text) for r in lined])
    assert {r.doc_id for r in single} == {i for i, (_, c) in groups.items() if c == i}
    assert {r.doc_id for r in masked} == {r.doc_id for r in single}
    for r in masked:
        assert not brute_spans(r.text) and r.n_chars == len(r.text)
    before = {r.doc_id: r.text for r in single}
    for r in masked:
        if not brute_spans(before[r.doc_id]) and "<SECRET>" not in r.text:
            assert r.text == before[r.doc_id]
    count = collections.Counter()
    for r in packed:
        count[r.doc_id] += r.n_words
    assert count == {r.doc_id: len(words(r.text)) for r in masked}
    bins = collections.defaultdict(list)
    for r in packed:
        bins[r.bin_id].append(r)
    bins.pop(None, None)
    for b in bins.values():
        assert sum(r.n_words for r in b) <= op5_packing.CAPACITY
        assert len({r.source for r in b}) == len(b) == len({r.cluster for r in b})


def test_search_over_shards_equals_brute_force(spark):
    """Many small shards (by words) give the ranking of one scan over all documents."""
    rng = random.Random(11)
    vocabulary = [f"w{i}" for i in range(60)] + [f"rare{i}" for i in range(400)]
    texts = {i: " ".join(rng.choice(vocabulary[:60] if rng.random() < 0.7 else vocabulary)
                         for _ in range(rng.choice([0, 1, 5, 40, 200]))) for i in range(300)}
    texts[7] = texts[140]  # a tie
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    queries = docs.filter("doc_id % 20 = 0").withColumnRenamed("doc_id", "query_id")
    got = {(r.query_id, r.rank): (r.doc_id, r.score)
           for r in op1_search.search(docs, queries, shard_words=2_000).collect()}
    bags = {i: collections.Counter(t.lower().split()) for i, t in texts.items()}
    df = collections.Counter(t for w in bags.values() for t in w)
    n = sum(1 for w in bags.values() if w)
    mean = sum(sum(w.values()) for w in bags.values()) / n
    k1, b = op1_search.K1, op1_search.B
    want = {}
    for q in range(0, 300, 20):
        found = []
        for i, w in bags.items():
            shared = bags[q].keys() & w.keys()
            if shared:
                norm = k1 * (1 - b + b * sum(w.values()) / mean)
                s = sum(math.log(1 + (n - df[t] + 0.5) / (df[t] + 0.5)) * w[t] * (k1 + 1) / (w[t] + norm)
                        for t in shared)
                found.append((-round(s, op1_search.DIGITS), i))
        for rank, (s, i) in enumerate(sorted(found)[:op1_search.TOP], 1):
            want[q, rank] = (i, -s)
    assert got.keys() == want.keys()
    assert all(got[x][0] == want[x][0] and abs(got[x][1] - want[x][1]) < 2e-6 for x in want)


@pytest.mark.parametrize("seed", range(6))
def test_long_queries_with_near_ties(seed):
    """Queries of 10,000 distinct words; documents whose scores differ by less than single precision tells."""
    rng = np.random.default_rng(seed)
    n, terms = 400, 10_000
    present = rng.random((n, terms)) < 0.97
    present[1::2] = present[::2]  # pairs that differ in one word
    present[np.arange(1, n, 2), rng.integers(0, terms, n // 2)] ^= True
    doc, term = (x.astype(np.int32) for x in np.nonzero(present))
    names = np.arange(1, terms + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    order = np.lexsort((names[term], doc))
    doc, term = doc[order], term[order]
    shard = op1_search.Shard([np.arange(n), doc, names[term], np.ones(len(doc), np.int32),
                              present.sum(axis=1).astype(np.int64)], float(terms))
    # Weights between 5 and 5.0001: all scores lie close to each other, in the ten thousands.
    weights = 5 + 1e-4 * rng.random(terms)
    by_name = np.argsort(names)
    (got,) = shard.search([(names[by_name], weights[by_name])], 10)
    every = np.round(shard.exact(np.arange(n), np.arange(terms), weights[by_name]), op1_search.DIGITS)
    want = np.lexsort((np.arange(n), -every))[:10]
    assert got[1].tolist() == want.tolist() and got[2].tolist() == every[want].tolist()


def test_pipeline_cuts_frequent_lines(spark):
    """Lines above the limits are cut out of the documents that stay; nothing else changes."""
    menu = ["Home | News | About us", "All rights reserved"]
    rows = [(i, "\n".join([menu[0], "", *[f"story {i} line {k} with some more words" for k in range(8)], "  ", menu[1]]),
             "en", "s0" if i % 2 else None, 0) for i in range(60)]
    rows += [(99, "too short", "en", "s0", 9), (98, None, "en", "s0", 0), (97, rows[0][1], "en", "alone", 0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    got = {r.doc_id: r for r in corpus_pipeline.quality_rules(spark, docs, SF_SMALL).collect()}
    assert set(got) == {*range(60), 97}
    for i, text, *_ in rows[:60]:
        want = "\n".join(x for x in text.split("\n") if x not in menu)
        assert (got[i].text, got[i].n_chars) == (want, len(want))
    assert got[97].text == rows[0][1]  # another host
