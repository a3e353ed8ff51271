"""Findings of round 3: page differencing on marked pages, links between holders of popular passages."""

import random

import numpy as np
import pytest

from sluice.llm import op7_pieces, op9_html, op10_chains


def test_differencing_decides_about_the_articles_of_marked_pages(spark):
    rng = random.Random(4)

    def words(n):
        return " ".join("".join(rng.choice("aeioulnrst") for _ in range(6)) for _ in range(n))

    teasers = "".join(f"<article><h3>{words(3)}</h3><p>{words(6)}</p></article>" for _ in range(2))
    rows, want = [], {}
    for i in range(40):
        host = f"h{i % 2}.example"
        body = [words(30), "A line of both.", words(30)]
        main = f"<article><h1>Title {i}</h1>{''.join(f'<p>{x}</p>' for x in body)}</article>"
        rows.append((i, f"http://{host}/a/{i:03d}", f"<body><nav>x</nav>{main}{teasers}<footer>y</footer></body>"))
        # The same teasers on every page are the site's frame; a line that two articles share is of both.
        want[i] = "\n".join([f"Title {i}", *body])
    # Copies of each other tell nothing about a frame; a page with no neighbour keeps all.
    both = f"<article><p>{words(20)}</p></article><article><p>{words(5)}</p></article>"
    rows += [(100, "http://copy.example/1", both), (101, "http://copy.example/2", both), (102, "http://one.example/", both)]
    for i in (100, 101, 102):
        want[i] = both.replace("</p></article><article><p>", "\n").replace("<article><p>", "").replace("</p></article>", "")
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(5)
    assert {r.page_id: r.text for r in op9_html.main_text(pages).collect()} == want


def test_units_of_a_page():
    lines, units, marked = op9_html.page_units(
        "<article><p>a</p><p>b</p><article><p>c</p></article></article><p>out</p><article><p>d</p></article>")
    assert (lines, marked) == (["a", "b", "c", "d"], True)
    assert units[0] == units[1] == units[2] != units[3]
    assert op9_html.page_units("<main><p>a</p><p>b</p></main><p>c</p>") == (["a", "b"], [0, 0], True)
    assert op9_html.page_units("<p>a</p><p>b</p>") == (["a", "b"], [0, 1], False)
    assert op9_html.whole_units([0, 1, 3], [5, 5, 6, 6]) == [0, 1]


def test_links_between_holders_of_popular_clauses(spark):
    """Two popular halves in a row: only two documents (then ten) hold both, and each half has another hub."""
    rng = random.Random(41)
    fresh = lambda n: [f"v{rng.randrange(10 ** 9)}" for _ in range(n)]
    for holders, both in ((3, 2), (12, 2), (12, 10)):
        left, right = fresh(30), fresh(30)
        rows, i = [], 0
        for part in (left, right):
            for _ in range(holders):  # with more shared text, so that they are the hubs
                rows.append((i, fresh(20) + part + fresh(20)))
                i += 1
        extra = fresh(45)
        rows += [(i + k, fresh(9) + part + fresh(9) + extra) for k, part in enumerate((left, right, left, right))]
        wanted = set(range(100, 100 + both))
        rows += [(k, fresh(15) + left + fresh(1) + right + fresh(15)) for k in wanted]
        docs = spark.createDataFrame([(k, " ".join(w)) for k, w in rows], "doc_id long, text string")
        got = [r for r in op10_chains.fuzzy_passages(docs).collect()
               if {r.doc_id, r.other_doc_id} <= wanted and r.end_word - r.start_word >= 60]
        reached = {100}
        for _ in wanted:
            reached |= {x for r in got if {r.doc_id, r.other_doc_id} & reached for x in (r.doc_id, r.other_doc_id)}
        assert reached == wanted, (holders, both)


def test_copies_are_told_by_their_first_document(spark):
    rng = random.Random(43)
    fresh = lambda n: [f"v{rng.randrange(10 ** 9)}" for _ in range(n)]
    whole = fresh(70)
    rows = [(k, " ".join(whole)) for k in (5, 3, 9)] + [(7, " ".join(fresh(10) + whole)), (8, "short"), (6, "short")]
    got = op10_chains.fuzzy_passages(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted(tuple(r) for r in got) == [
        (5, 0, 70, 3, 0, 70, 70), (7, 10, 80, 3, 0, 70, 70), (9, 0, 70, 3, 0, 70, 70)]


def test_portions_are_bounded_by_texts_and_characters(monkeypatch):
    monkeypatch.setattr(op7_pieces, "DOCS_AT_ONCE", 3)
    monkeypatch.setattr(op7_pieces, "CHARS_AT_ONCE", 10)
    assert list(op7_pieces.portions([1, 1, 1, 1, 50, 4, 6, 1])) == [(0, 3), (3, 4), (4, 5), (5, 7), (7, 8)]
    assert list(op7_pieces.portions([])) == [] and list(op7_pieces.portions([99])) == [(0, 1)]


@pytest.mark.parametrize("dropout", [0.1, 0.6])
def test_courses_with_skips_behind_skips(dropout):
    """Chains of skipped candidates, plain chunks and those with byte pieces, against one occurrence at a time."""
    pieces = op7_pieces.load_pieces()
    rng = random.Random(5)
    vocab = ["the", "internationalisation", "\u2603snow", "caf\u00e9", "a\u4e2db", "Straßenbahn", op7_pieces.MARK, "x" * 80]
    texts = [" ".join(rng.choice(vocab) for _ in range(60)) for _ in range(30)]
    sampler = op7_pieces.Sampler(pieces, dropout, 11)
    for _ in range(2):  # the second time from kept courses
        got = sampler.encode_all(texts, list(range(30)))
        for doc, text in enumerate(texts):
            chunks = pieces.chunk.findall(" " + text)
            keys = sampler._keys(len(chunks), doc).tolist()
            want = [i for c, k in zip(chunks, keys, strict=True) for i in op7_pieces.encode_chunk(c, pieces, k, dropout)]
            assert np.array_equal(got[doc], want)
