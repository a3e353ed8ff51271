"""Main text of web pages: markup rules, and nearest-URL page differencing.

Each page's html is cut into blocks; scripts, styles, menus, headers, footers,
sidebars, notices, adverts, forms and comments are left out by element, role
and class, up to where HTML ends them, also without their end tag. If the page marks its article (``article``, else ``main``),
only what that holds is looked at. Every page is compared with the nearest
page of its host in URL path order: both pages' lines are aligned by their
longest common subsequence, and the shared lines are taken for the site's frame
and deleted by units. Where no markup says what belongs together a unit is a
line; an ``article`` element is one unit, deleted if all its lines are shared
(the same teaser on both pages) and whole otherwise: a line that two articles
have in common belongs to both. If the shared lines are more than half of either page the two are
copies of each other, which tells nothing about a frame, and all lines stay.

Neighbours are found on one global range order of (host, path), so a host
with a third of all pages is spread over tasks like any other; only the first
and the last page of each partition, two rows per partition, meet in one task.
"""

from __future__ import annotations

import html
import re
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sluice.llm._stage import arrow_map, staged

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|<(?P<raw>script|style|textarea|template|noscript|iframe|svg|title)\b[^>]*>.*?(?:</(?P=raw)\s*>|\Z)"
    r"|<(?P<close>/?)(?P<name>[a-zA-Z][a-zA-Z0-9:-]*)(?P<attrs>(?:\"[^\"]*\"|'[^']*'|[^'\">])*+)(?:>|\Z)"
    r"|<(?P<close2>/?)(?P<name2>[a-zA-Z][a-zA-Z0-9:-]*)(?P<attrs2>[^>]*)(?:>|\Z)"
    r"|<[/!?][^>]*(?:>|\Z)"
    r"|(?P<text>[^<]+|<)", re.S | re.I)
_ATTR = re.compile(r"(?:^|\s)(class|id|role|hidden|aria-hidden)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?",
                   re.I)

# Element names, roles and class words that mark what is not the article.
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_BLOCK = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure "
    "footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol optgroup option p pre "
    "section summary table tbody td tfoot th thead tr ul".split())
_DROP = frozenset("nav footer aside form menu button select dialog head object audio video canvas map".split())
_DROP_ROLES = frozenset("navigation banner contentinfo complementary search form alert dialog menu menubar".split())
_DROP_WORDS = frozenset(
    "ad ads adv advert adverts advertisement advertising banner breadcrumb breadcrumbs comment comments consent "
    "cookie cookies disqus footer gdpr masthead menu modal nav navbar navigation newsletter notice popup promo "
    "related respond share sharing sidebar skip social sponsor sponsored subscribe toolbar widget".split())
# Words that say nothing by themselves: "share-box" is a share bar, "related-work" is not about related pages.
_PLAIN_WORDS = frozenset("area bar block box btn button buttons container content icon icons inner item items left "
                         "line link links list main outer panel right section strip top wrap wrapper".split())
_COMMENT_IDS = frozenset("comments comment disqus respond".split())
_TABLE = frozenset("table caption thead tbody tfoot tr td th".split())
# Start tag -> the open elements it ends, and where the search for them stops: end
# tags that HTML lets one leave out.
_ENDS = {"li": ({"li"}, {"ul", "ol", "menu", "dir"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
         "option": ({"option"}, {"select", "optgroup", "datalist"}), "optgroup": ({"option", "optgroup"}, {"select"}),
         "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}),
         "tr": ({"tr", "td", "th", "caption"}, {"table"}),
         **dict.fromkeys(("thead", "tbody", "tfoot"), ({"thead", "tbody", "tfoot", "tr", "td", "th", "caption"}, {"table"}))}
# Dropped elements that never are the right parent of the page's article: one inside is what the page is about.
_YIELDS = frozenset("nav form menu header button select".split())


def _marked(value: str, inside: bool) -> bool:
    """Whether a class says that an element is not the article. Inside the
    article the whole class name must say so."""
    for token in value.split():
        parts = [p for p in re.split(r"[_-]+", token) if p]
        if not _DROP_WORDS.isdisjoint(parts) and (
                not inside or all(p in _DROP_WORDS or p in _PLAIN_WORDS for p in parts)):
            return True
    return False


def _dropped(name: str, attrs: str, inside: bool) -> bool:
    if name in _DROP or (name == "header" and not inside):
        return True
    if name in ("html", "body", "main") or (name == "article" and not inside) or not attrs:
        return False
    for m in _ATTR.finditer(attrs):
        key, value = m.group(1).lower(), (m.group(2) or m.group(3) or m.group(4) or "").lower()
        if key == "hidden" or (key == "aria-hidden" and value == "true"):
            return True
        if key == "role" and value.strip() in _DROP_ROLES:
            return True
        if key == "class" and _marked(value, inside):
            return True
        if key == "id" and (value.strip() in _COMMENT_IDS if inside else _marked(value, False)):
            return True
    return False


class _Open:
    """The open elements of a page: (name, whether its content is left out)."""

    def __init__(self) -> None:
        self.stack: list[tuple[str, bool]] = []
        self.depth = {"article": 0, "main": 0}  # those whose content counts
        self.articles = 0  # so far, not counting those inside another one

    def off(self) -> bool:
        return bool(self.stack) and self.stack[-1][1]

    def push(self, name: str, off: bool) -> None:
        self.stack.append((name, off))
        if name in self.depth and not off:
            self.articles += name == "article" and not self.depth[name]
            self.depth[name] += 1

    def pop_to(self, k: int) -> None:
        while len(self.stack) > k:
            name, off = self.stack.pop()
            if name in self.depth and not off:
                self.depth[name] -= 1

    def implied_ends(self, name: str) -> None:
        """Ends what the start of ``name`` ends."""
        if name in _ENDS:
            targets, stops = _ENDS[name]
            at = -1
            for k in range(len(self.stack) - 1, -1, -1):
                if self.stack[k][0] in targets:
                    at = k
                elif self.stack[k][0] in stops:
                    break
            if at >= 0:
                self.pop_to(at)
        if name in _BLOCK:  # no block lies in a paragraph
            for k in range(len(self.stack) - 1, -1, -1):
                if self.stack[k][0] == "p":
                    self.pop_to(k)
                if self.stack[k:] == [] or self.stack[k][0] in _BLOCK:
                    break

    def end(self, name: str) -> None:
        """An end tag: ends its element and all that is open inside. One that
        belongs to nothing open here ends nothing."""
        if name in ("html", "body"):
            return
        for k in range(len(self.stack) - 1, -1, -1):
            here = self.stack[k][0]
            if here == name:
                self.pop_to(k)
                return
            if name not in _BLOCK and name not in _DROP and here in _BLOCK:
                return  # an inline end tag does not reach out of its block
            if here in _TABLE and name not in _TABLE:
                return  # nor any other out of a table's cell


def page_units(page: str) -> tuple[list[str], list[int], bool]:
    """(lines, the unit of each, whether the page marks its article): the lines
    of the article, or of everything that no rule leaves out.

    Lines of one ``article`` element, or of ``main``, are one unit; on a page
    that marks nothing every line is its own.

    A left-out element ends with its end tag, with that of an element around
    it, or where HTML implies its end. An article inside a menu, header or form
    (a form round the whole page, a menu that nobody closed) counts.
    """
    blocks: list[tuple[str, int, int]] = []
    parts: list[str] = []
    seen = {"article": False, "main": False}
    tree = _Open()

    def flush() -> None:
        if parts:
            line = " ".join("".join(parts).split())
            parts.clear()
            if line:
                blocks.append((line, 2 if tree.depth["article"] else 1 if tree.depth["main"] else 0, tree.articles))

    for m in _TOKEN.finditer(page):
        text = m.group("text")
        if text is not None:
            if not tree.off():
                parts.append(html.unescape(text) if "&" in text else text)
            continue
        name = m.group("name") or m.group("name2")
        if name is None:
            continue  # comment, declaration or raw element
        name = name.lower()
        attrs = m.group("attrs") or m.group("attrs2") or ""
        if name in _BLOCK:
            flush()
        elif name == "br" and not tree.off():
            parts.append(" ")
        if name in _VOID:
            continue
        if m.group("close") or m.group("close2"):
            tree.end(name)
            continue
        if name in _ENDS or name in _BLOCK:
            tree.implied_ends(name)
        off = tree.off()
        if off and name in seen:
            root = next(n for n, left_out in tree.stack if left_out)
            off = root not in _YIELDS or _dropped(name, attrs, True)
        elif not off and _dropped(name, attrs, any(tree.depth.values())):
            off = True
        if attrs.endswith("/") and name not in seen:
            continue  # closed by itself
        tree.push(name, off)
        if name in seen and not off:
            seen[name] = True
    flush()
    level = 2 if seen["article"] else 1 if seen["main"] else 0
    lines = [line for line, at, _ in blocks if at >= level]
    units = [unit if level == 2 else 0 for _, at, unit in blocks if at >= level] if level else list(range(len(lines)))
    return lines, units, level > 0


def page_lines(page: str) -> tuple[list[str], bool]:
    """(lines, whether the page marks its article), see ``page_units``."""
    lines, _, marked = page_units(page)
    return lines, marked


def common_lines(a: list[int], b: list[int]) -> list[tuple[int, int]]:
    """Index pairs of a longest common subsequence (Hunt and Szymanski)."""
    lo = 0
    while lo < min(len(a), len(b)) and a[lo] == b[lo]:
        lo += 1
    hi = 0
    while hi < min(len(a), len(b)) - lo and a[-1 - hi] == b[-1 - hi]:
        hi += 1
    where: dict[int, list[int]] = {}
    for j in range(len(b) - hi - 1, lo - 1, -1):
        where.setdefault(b[j], []).append(j)  # descending
    ends: list[int] = []
    links: list[tuple] = []
    for i in range(lo, len(a) - hi):
        for j in where.get(a[i], ()):
            k = bisect_left(ends, j)
            link = (i, j, links[k - 1] if k else None)
            if k == len(ends):
                ends.append(j)
                links.append(link)
            elif j < ends[k]:
                ends[k], links[k] = j, link
    middle = []
    link = links[-1] if links else None
    while link:
        middle.append(link[:2])
        link = link[2]
    return ([(k, k) for k in range(lo)] + middle[::-1]
            + [(len(a) - k, len(b) - k) for k in range(hi, 0, -1)])


def whole_units(lines: list[int], units: list[int]) -> list[int]:
    """Those of the lines ``lines`` (indexes, ascending) whose unit is among them as a whole."""
    if not lines:
        return []
    size, got = Counter(units), Counter(units[i] for i in lines)
    return [i for i in lines if got[units[i]] == size[units[i]]]


def shared_lines(a: list[int], a_sizes: list[int], b: list[int], b_sizes: list[int]) -> list[int]:
    """Indexes of ``a``'s lines that its neighbour has too, if they may be a frame."""
    both = common_lines(a, b)
    if (2 * sum(a_sizes[i] for i, _ in both) > sum(a_sizes)
            or 2 * sum(b_sizes[j] for _, j in both) > sum(b_sizes)):
        return []
    return [i for i, _ in both]


def _host_path(url: str | None) -> tuple[str, str]:
    rest = (url or "").split("://", 1)[-1]
    host, _, path = rest.partition("/")
    return host.lower().split(":")[0], "/" + re.split(r"[?#]", path, maxsplit=1)[0]


def _line_key(line: str) -> int:
    import xxhash
    return xxhash.xxh64_intdigest(line.encode()) - (1 << 63)


def _extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        rows = [page_lines(h.as_py() or "") for h in b.column("html")]
        yield b.drop_columns(["html"]).append_column("lines", pa.array([r[0] for r in rows], pa.list_(pa.string())))


def _outline(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """What differencing needs of a page: its place, and its lines' hashes, sizes and units."""
    longs, ints = pa.list_(pa.int64()), pa.list_(pa.int32())
    for b in batches:
        rows = [page_units(h.as_py() or "") for h in b.column("html")]
        places = [_host_path(u.as_py()) for u in b.column("url")]
        yield pa.RecordBatch.from_arrays(
            [pa.array([p[0] for p in places]), pa.array([p[1] for p in places]), b.column("page_id"), b.column("h"),
             pa.array([[_line_key(x) for x in r[0]] for r in rows], longs),
             pa.array([[len(x) for x in r[0]] for r in rows], ints), pa.array([r[1] for r in rows], ints)],
            names=["host", "path", "page_id", "h", "lines", "sizes", "units"])


_OUTLINE = ("host string, path string, page_id long, h long, lines array<long>, sizes array<int>, units array<int>")
_RELATION = ("page_id long, h long, near int, before boolean, removed array<long>, "
             "edge struct<host:string,path:string,page_id:long,h:long,lines:array<long>,"
             "sizes:array<int>,units:array<int>,first:boolean,last:boolean>")


def _prefix(a: str, b: str) -> int:
    n = 0
    for x, y in zip(a, b, strict=False):
        if x != y:
            break
        n += 1
    return n


def _relations(a: dict, b: dict) -> Iterator[dict]:
    """What a pair of neighbouring pages says about each."""
    if a["host"] == b["host"]:
        near = _prefix(a["path"], b["path"])
        for x, y, before in ((a, b, False), (b, a, True)):
            shared = shared_lines(x["lines"], x["sizes"], y["lines"], y["sizes"])
            yield {"page_id": x["page_id"], "h": x["h"], "near": near, "before": before,
                   "removed": whole_units(shared, x["units"]), "edge": None}


def _batch(rows: list[dict]) -> pa.RecordBatch:
    edge = pa.struct([("host", pa.string()), ("path", pa.string()), ("page_id", pa.int64()), ("h", pa.int64()),
                      ("lines", pa.list_(pa.int64())), ("sizes", pa.list_(pa.int32())),
                      ("units", pa.list_(pa.int32())), ("first", pa.bool_()), ("last", pa.bool_())])
    return pa.RecordBatch.from_pylist(rows, schema=pa.schema([
        ("page_id", pa.int64()), ("h", pa.int64()), ("near", pa.int32()), ("before", pa.bool_()),
        ("removed", pa.list_(pa.int64())), ("edge", edge)]))


def _edge(row: dict, first: bool, last: bool) -> dict:
    return {"page_id": None, "h": None, "near": None, "before": None, "removed": None,
            "edge": row | {"first": first, "last": last}}


def _within(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Relations of consecutive pages of a sorted partition, and its two end rows."""
    first = prev = None
    n = 0
    for b in batches:
        out = []
        for row in b.to_pylist():
            n += 1
            if prev is None:
                first = row
            else:
                out += _relations(prev, row)
            prev = row
        if out:
            yield _batch(out)
    if n == 1:
        yield _batch([_edge(first, True, True)])
    elif n:
        yield _batch([_edge(first, True, False), _edge(prev, False, True)])


def _between(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Relations of one partition's last page and the next one's first."""
    prev = None
    for b in batches:
        out = []
        for row in b.to_pylist():
            row = row["edge"]
            if prev is not None and prev["last"] and row["first"]:
                out += _relations(prev, row)
            prev = row
        if out:
            yield _batch(out)


def template_lines(pages: DataFrame) -> DataFrame:
    """(page_id, h, removed) for pages that share whole units of lines with
    their nearest neighbour; ``pages`` has page_id, h, url, html."""
    place = ["host", "path", "page_id", "h"]
    outline = staged(arrow_map(pages, _outline, _OUTLINE), "outline")
    ranged = outline.repartitionByRange(*place).sortWithinPartitions(*place)
    found = staged(arrow_map(ranged, _within, _RELATION), "relations")
    edges = (found.filter("edge is not null").select("edge").repartition(1)
             .sortWithinPartitions(*[f"edge.{c}" for c in place], F.desc("edge.first")))
    pairs = found.filter("edge is null").unionByName(arrow_map(edges, _between, _RELATION))
    # Of its two neighbours, the page's nearer one: longer common path, then the one before.
    removed = (pairs.groupBy("page_id", "h").agg(F.max(F.struct("near", "before", "removed")).alias("best"))
               .select("page_id", "h", F.col("best.removed").alias("removed")).filter(F.size("removed") > 0))
    return staged(removed, "removed")  # few pages: the join with all texts goes by what is left, not by all relations


def main_text(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """(page_id, url, text, n_chars) for every row of ``pages``.

    Character references are decoded, white space inside a block becomes one
    space, blocks are joined in page order by one newline. A null or empty
    html gives an empty text; a null url is a host of its own. Rows that
    repeat an id are extracted each on its own. Other columns are ignored. An
    empty table gives an empty result.
    """
    base = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).alias("url"),
                        F.xxhash64(F.col(url_col), F.col(html_col)).alias("h"), F.col(html_col).alias("html"))
    removed = template_lines(base)
    lines = arrow_map(base, _extract, "page_id long, url string, h long, lines array<string>")
    return (lines.alias("l").join(removed.alias("r"), F.expr("l.page_id <=> r.page_id and l.h = r.h"), "left")
            .select("l.page_id", "l.url", F.when(F.col("removed").isNull(), F.col("lines")).otherwise(
                F.filter("lines", lambda x, i: ~F.array_contains(F.col("removed"), i.cast("long")))).alias("lines"))
            .select("page_id", "url", F.array_join("lines", "\n").alias("text"))
            .withColumn("n_chars", F.length("text").cast("long")))
