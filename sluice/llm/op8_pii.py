"""Personal data by weak supervision.

Fixed patterns give the base spans (email, ip, card, phone). Further spans come
from voters: kind ``secret`` (keys, tokens, passwords) from format and hex
patterns, a gazetteer of key names, and labelers of context and shape; kind
``name`` (persons) from gazetteers of given names, titles and labels, and
labelers of shape and of ordinary words; kind ``id`` (national and account
numbers) from formats, check digits, labels and context. Each voter votes for
(1), against (-1) or not at all (0) on every candidate of its kind.
Expectation-maximisation over a kind's vote patterns estimates how reliable each
voter is and gives each pattern its probability; a naive Bayes span classifier
over shape and context features is trained on all candidates with these soft
labels and decides. There are at most 3**7 vote patterns and 16 values for
each of the features of a kind, so the models have a size that does not depend
on the data.
"""

from __future__ import annotations

import hashlib
import math
import re
from bisect import bisect_right
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sluice.llm._stage import arrow_map, staged

BASE_KINDS = ("email", "ip", "card", "phone")
LEARNED_KINDS = ("secret", "name", "id")
KINDS = (*BASE_KINDS, *LEARNED_KINDS)
SECRET, NAME, ID = range(len(BASE_KINDS), len(KINDS))
MIN_TOKEN, LONG_WORD = 8, 16

# Patterns of the base kinds.
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
# A digit run that fails from its first digit fails from all others.
_IP = re.compile(r"(?<![0-9])[0-9]++(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_DIGIT = re.compile(r"[0-9]")

# Names that introduce a secret, and prefixes of issued keys.
_KEY_NAME = re.compile(r"(?:password|passwd|pwd|secret|token|api[_-]?key|access[_-]?key|auth|credential)", re.I)
_NAMED = re.compile(_KEY_NAME.pattern + r"[\"']?\s{0,4}[=:]\s{0,4}[\"']?$", re.I)
_ASSIGNED = re.compile(r"[=:]\s{0,4}[\"']?$")
_AFTER_WORD = re.compile(r"[^\W\d_][,.]?\s$")
_FORMAT = re.compile(r"(?:AKIA|ASIA)[A-Z0-9]{16}$|gh[pousr]_[A-Za-z0-9]{20,}$|sk-[A-Za-z0-9]{16,}$")
_HEX = re.compile(r"(?=[0-9a-fA-F]*[0-9])(?=[0-9a-fA-F]*[a-fA-F])[0-9a-fA-F]{16,}$")
_TOKEN = re.compile(r"[A-Za-z0-9_+/-]{8,}")
_PLAIN_WORD = re.compile(r"[A-Z]?[a-z]+$|[A-Z]+$")

# Gazetteers of titles, labels, given names and ordinary words, and forms of numbers.
_TITLES = frozenset("Mr Mrs Ms Miss Dr Prof Sir Herr Frau Monsieur Madame Mademoiselle Mme Señor Señora Sr Sra Don "
                    "Doña".split())
_NAME_LABELS = frozenset("Name Author Contact Customer Patient Employee Student Applicant Signed Attn".split())
_GIVEN = frozenset(
    "James John Robert Michael William David Richard Joseph Thomas Charles Mary Patricia Jennifer Linda Elizabeth "
    "Barbara Susan Jessica Sarah Karen Hans Peter Klaus Jürgen Wolfgang Heike Ursula Sabine Renate Monika Jean Pierre "
    "Michel Philippe Jacques Marie Nathalie Isabelle Sylvie Françoise José Juan Antonio Manuel Francisco Carmen "
    "Dolores Pilar Josefa Teresa Ahmed Mohammed Fatima Wei Li Yuki Ivan Olga Anna Maria Paul Daniel".split())
_INTRODUCERS = _TITLES | _NAME_LABELS | _GIVEN
_ORDINARY = frozenset(
    "The This That These Those And But For With From Not You Your When What Where Who How All Our His Her It We He She "
    "Der Die Das Und Ein Eine Nicht Les Des Une Est Dans Pour Avec El Los Las Una Con Por Para Que Como Del".split())
_CAPITAL = re.compile(r"[A-ZÀ-ÖØ-Þ][a-zß-öø-ÿ]+")
_NAME_WORD = r"(?:[A-Z]\.\s)?(?:[A-Z]')?" + _CAPITAL.pattern
_NAME_WORDS = re.compile(rf"{_NAME_WORD}(?:[ -]{_NAME_WORD}){{0,2}}")
_ID_FORMS = re.compile(r"(?<![\w-])(?:[0-9]{3}-[0-9]{2}-[0-9]{4}|[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?"
                       r"|[A-Z]{0,3}[0-9][A-Z0-9-]{4,13}[A-Z0-9])(?![\w-])")
_ID_LABEL = re.compile(r"(?:ssn|social security|passport|national id|tax id|iban|account|insurance|identity card|"
                       r"steuer-?id|dni|nie|insee)(?: (?:no|number|nr|num)\.?)?\s{0,2}[:#=]?\s{0,2}$", re.I)
_ID_HINT = re.compile(r"[0-9]{3}-[0-9]{2}-[0-9]{4}|[A-Z]{2}[0-9]{2} ?[A-Z0-9]{4}")
_ID_LABELS = ("ssn", "security", "passport", "national id", "tax id", "iban", "account", "insurance", "identity", "steuer",
              "dni", "nie", "insee")


def _luhn(digits: str) -> bool:
    total = 0
    for k, d in enumerate(reversed(digits)):
        v = int(d) * (1 + k % 2)
        total += v - 9 * (v > 9)
    return total % 10 == 0


def emails(text: str) -> list[tuple[int, int]]:
    """Leftmost matches, found from each ``@``: a run of local characters
    reaches back to the last other character or the last match."""
    out, done, at = [], 0, text.find("@")
    while at >= 0:
        m = _DOMAIN.match(text, at + 1)
        if m and at >= done:
            start = at
            while start > done and text[start - 1] in _LOCAL:
                start -= 1
            if start < at:
                out.append((start, m.end()))
                done = m.end()
        at = text.find("@", at + 1)
    return out


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """Spans of the base kinds, by kind and start, in code points."""
    out = [("email", s, e) for s, e in emails(text)] if "@" in text else []
    if _DIGIT.search(text):
        if "." in text:
            for m in _IP.finditer(text):
                parts = [p.lstrip("0") for p in m.group().split(".")]
                if all(len(p) <= 3 and int(p or "0") <= 255 for p in parts):
                    out.append(("ip", m.start(), m.end()))
        for m in _CARD.finditer(text):
            digits = m.group().replace(" ", "").replace("-", "")
            if 13 <= len(digits) <= 19 and _luhn(digits):
                out.append(("card", m.start(), m.end()))
        if "+" in text:
            for m in _PHONE.finditer(text):
                if 9 <= len(_DIGIT.findall(m.group())) <= 15:
                    out.append(("phone", m.start(), m.end()))
    return out


def _bucket(share: float) -> int:
    return min(5, math.ceil(share * 5))


def votes_and_features(text: str, start: int, end: int) -> tuple[int, list[int]]:
    """The vote pattern (base 3) and the features (16 values each) of a token."""
    token, before, after = text[start:end], text[max(0, start - 40):start], text[end:end + 1]
    n = len(token)
    digits = sum(c.isdigit() for c in token)
    upper = sum(c.isupper() for c in token)
    kinds = [0 if c.isdigit() else 1 if c.isupper() else 2 for c in token]
    turns = sum(a != b for a, b in zip(kinds[1:], kinds[:-1], strict=True))
    counts = [token.count(c) for c in set(token)]
    entropy = -sum(c / n * math.log2(c / n) for c in counts)
    hexed = bool(_HEX.match(token))
    assigned = bool(_ASSIGNED.search(before))
    named = bool(_NAMED.search(before))
    plain = bool(_PLAIN_WORD.match(token))
    votes = [
        1 if _FORMAT.match(token) else 0,
        1 if hexed else 0,
        1 if named else 0,
        1 if assigned else -1 if _AFTER_WORD.search(before) else 0,
        1 if digits and turns >= 3 else -1 if not digits else 0,
        -1 if plain else 0,
        1 if digits and entropy >= 3 else -1 if not digits or entropy < 2 else 0,
    ]
    pattern = 0
    for v in votes:
        pattern = pattern * 3 + v + 1
    left = 0 if assigned else 1 if before[-1:].isspace() or not before else 2
    right = 0 if after in ("\"", "'") else 1 if after.isspace() or not after else 2
    values = [min(15, n // 4), _bucket(digits / n), _bucket(upper / n), min(15, turns), min(15, int(entropy * 3)),
              int(hexed), int(plain), left, right, int(named)]
    return pattern, [16 * k + v for k, v in enumerate(values)]


N_VOTERS = 7
N_FEATURES = 10


def _iban(number: str) -> bool:
    """The check digits of an account number: 97 divides it with its head moved back."""
    n = number.replace(" ", "")
    return 15 <= len(n) <= 34 and int("".join(str(int(c, 36)) for c in n[4:] + n[:4])) % 97 == 1


def _code(votes: list[int], values: list[int]) -> tuple[int, list[int]]:
    pattern = 0
    for v in (*votes, *[0] * (N_VOTERS - len(votes))):
        pattern = pattern * 3 + v + 1
    return pattern, [16 * k + min(15, v) for k, v in enumerate(values)]


def _clear(taken: list[tuple[int, int]], start: int, end: int) -> bool:
    """Whether no span of the sorted, disjoint ``taken`` meets start..end."""
    k = bisect_right(taken, (start, end))
    return not (k and taken[k - 1][1] > start) and not (k < len(taken) and taken[k][0] < end)


def names(text: str, taken: list[tuple[int, int]]) -> Iterator[tuple[int, int, int, list[int]]]:
    """(start, end, pattern, features) of capitalised words that a title, a
    label or a given name introduces."""
    if _INTRODUCERS.isdisjoint(_CAPITAL.findall(text)):
        return
    done = 0
    for m in _CAPITAL.finditer(text):
        word, start = m.group(), m.start()
        if start < done or word not in _INTRODUCERS:
            continue
        before = text[start - 1:start]
        if before.isalnum():
            continue
        title, label, given = word in _TITLES, word in _NAME_LABELS, word in _GIVEN
        at = start
        if not given:
            at = m.end()
            gap = text[at:at + 3]
            at += 1 if gap[:1] == "." and title or gap[:1] == ":" and label else 0
            if label and text[at - 1:at] != ":" or text[at:at + 1] != " ":
                continue
            at += 1
        n = _NAME_WORDS.match(text, at)
        if not n or not _clear(taken, at, n.end()):
            continue
        words = [w for w in re.split("[ -]", n.group()) if w]
        known = sum(w in _GIVEN for w in words)
        if given and len(words) == 1 or words[0] in _TITLES:  # a second title introduces the name itself
            continue
        after = text[n.end():n.end() + 1]
        ordinary = sum(w in _ORDINARY for w in words)
        yield at, n.end(), *_code(
            [1 if title else 0, 1 if label else 0, 1 if known else 0, 1 if 2 <= len(words) <= 3 else 0,
             -1 if ordinary else 0, -1 if len(set(words)) < len(words) else 0,
             -1 if after.isalnum() else 0],
            [len(words), len(words[0]) // 2, len(words[-1]) // 2, int(title), int(label), known, ordinary,
             0 if before in "\n" else 1 if before == " " else 2, 0 if after in ".,;\n" else 1 if after == " " else 2,
             int("." in n.group())])
        done = n.end()


def id_numbers(text: str, taken: list[tuple[int, int]]) -> Iterator[tuple[int, int, int, list[int]]]:
    """(start, end, pattern, features) of numbers in the form of a national or
    account number, or behind a label of one."""
    if not _DIGIT.search(text):
        return
    low = text.lower()
    if not (_ID_HINT.search(text) or any(x in low for x in _ID_LABELS)):
        return
    for m in _ID_FORMS.finditer(text):
        number, (start, end) = m.group(), m.span()
        digits = sum(c.isdigit() for c in number)
        label = bool(_ID_LABEL.search(text[max(0, start - 30):start]))
        social = number[3:4] == "-" and number[6:7] == "-" and len(number) == 11
        account = number[:2].isalpha() and number[2:4].isdigit() and len(number) >= 15
        if not (social or account or label) or digits < 5 or not _clear(taken, start, end):
            continue
        good = social and number[:3] not in ("000", "666") and number[0] != "9" and number[4:6] != "00" and number[7:] != "0000"
        checked = account and _iban(number)
        before = text[start - 1:start]
        yield start, end, *_code(
            [1 if good else -1 if social else 0, 1 if checked else -1 if account else 0, 1 if label else 0,
             1 if social or checked else 0, -1 if len(set(number) - set(" -")) <= 2 else 0,
             -1 if before in "$€£/" and before else 0],
            [len(number) // 2, _bucket(digits / len(number)), int(social), int(good), int(account), int(checked), int(label),
             number.count("-"), number.count(" "), 0 if before in "\n" else 1 if before == " " else 2])


def candidates(text: str, base: list[tuple[str, int, int]]) -> Iterator[tuple[int, int, int, list[int]]]:
    """(start, end, pattern, features) of tokens that a voter on secrets may vote for.

    A text without a digit and without a key name holds none: no voter votes
    for any of its tokens. Base spans are not candidates again.
    """
    if not (_DIGIT.search(text) or _KEY_NAME.search(text)):
        return
    taken = sorted((s, e) for _, s, e in base)
    k = 0
    for m in _TOKEN.finditer(text):
        start, end = m.span()
        while k < len(taken) and taken[k][1] <= start:
            k += 1
        if k < len(taken) and taken[k][0] < end:
            continue
        token = m.group()
        if not (any(c.isdigit() for c in token) or end - start >= LONG_WORD
                or _ASSIGNED.search(text[max(0, start - 6):start])):
            continue
        if start and _KEY_NAME.fullmatch(token):
            continue
        yield start, end, *votes_and_features(text, start, end)


def all_candidates(text: str, base: list[tuple[str, int, int]]) -> Iterator[tuple[int, int, int, int, list[int]]]:
    """(kind, start, end, pattern, features) of the candidates of every learned kind; none meets a base span."""
    taken: list[tuple[int, int]] = []
    for s, e in sorted((s, e) for _, s, e in base):  # base spans of different kinds may overlap
        if taken and s < taken[-1][1]:
            taken[-1] = (taken[-1][0], max(e, taken[-1][1]))
        else:
            taken.append((s, e))
    for kind, found in ((SECRET, candidates(text, base)), (NAME, names(text, taken)), (ID, id_numbers(text, taken))):
        for c in found:
            yield kind, *c


_SCAN = ("doc_id long, h long, base array<struct<kind:int,s:long,e:long>>, "
         "found array<struct<kind:int,s:long,e:long,pattern:int,features:array<int>>>")


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    base_t = pa.list_(pa.struct([("kind", pa.int32()), ("s", pa.int64()), ("e", pa.int64())]))
    found_t = pa.list_(pa.struct([("kind", pa.int32()), ("s", pa.int64()), ("e", pa.int64()), ("pattern", pa.int32()),
                                  ("features", pa.list_(pa.int32()))]))
    for b in batches:
        base, found = [], []
        for t in b.column("text"):
            text = t.as_py() or ""
            spans = base_spans(text)
            base.append([{"kind": BASE_KINDS.index(k), "s": s, "e": e} for k, s, e in spans])
            found.append([{"kind": k, "s": s, "e": e, "pattern": p, "features": f}
                          for k, s, e, p, f in all_candidates(text, spans)])
        yield pa.RecordBatch.from_arrays(
            [b.column("doc_id"), b.column("h"), pa.array(base, base_t), pa.array(found, found_t)],
            names=["doc_id", "h", "base", "found"])


def expectation_maximisation(counts: dict[int, int], rounds: int = 60) -> dict[int, float]:
    """Probability of being a secret for every vote pattern.

    Two classes; each voter has, per class, a distribution over its three
    votes (Laplace smoothing). The start is the majority of the votes cast.
    """
    votes = {p: [(p // 3 ** k) % 3 for k in range(N_VOTERS)] for p in counts}
    prob = {}
    for p, v in votes.items():
        s = sum(x - 1 for x in v)
        prob[p] = 0.9 if s > 0 else 0.1 if s < 0 else 0.5
    for _ in range(rounds):
        total = sum(counts.values())
        share = (1 + sum(counts[p] * prob[p] for p in counts)) / (2 + total)
        table = [[[1.0] * 3 for _ in range(N_VOTERS)] for _ in range(2)]
        for p, v in votes.items():
            for k, x in enumerate(v):
                table[1][k][x] += counts[p] * prob[p]
                table[0][k][x] += counts[p] * (1 - prob[p])
        logs = [[[math.log(x / sum(row)) for x in row] for row in cls] for cls in table]
        new = {}
        for p, v in votes.items():
            z = math.log(share / (1 - share)) + sum(logs[1][k][x] - logs[0][k][x] for k, x in enumerate(v))
            new[p] = 1 / (1 + math.exp(-max(-500.0, min(500.0, z))))
        done = max((abs(new[p] - prob[p]) for p in prob), default=0) < 1e-9
        prob = new
        if done:
            break
    return prob


def _soft(prob: dict[int, dict[int, float]]):
    """Adds to every kind's features the soft labels of its candidates, in millionths, per batch."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            pos, all_ = {}, {}
            for found in b.column("found").to_pylist():
                for c in found or ():
                    w = round(1e6 * prob[c["kind"]].get(c["pattern"], 0.5))
                    for f in (-1, *c["features"]):
                        key = c["kind"], f
                        pos[key] = pos.get(key, 0) + w
                        all_[key] = all_.get(key, 0) + 1_000_000
            keys = sorted(all_)
            yield pa.RecordBatch.from_arrays(
                [pa.array([k for k, _ in keys], pa.int32()), pa.array([f for _, f in keys], pa.int32()),
                 pa.array([pos[k] for k in keys], pa.int64()), pa.array([all_[k] for k in keys], pa.int64())],
                names=["kind", "feature", "pos", "n"])
    return run


def naive_bayes(rows: list[tuple[int, int, int]]) -> tuple[float, dict[int, float]]:
    """(bias, weight per feature) from (feature, positive mass, mass) rows; -1 is the total."""
    mass = {f: ((p + 1e6) / 1e6, (n - p + 1e6) / 1e6) for f, p, n in rows}
    if -1 not in mass:
        return -1.0, {}
    pos, neg = mass.pop(-1)
    return (math.log(pos / neg),
            {f: math.log(p / (pos + 16)) - math.log(q / (neg + 16)) for f, (p, q) in mass.items()})


def _decide(models: dict[int, tuple[float, dict[int, float]]]):
    columns = ["doc_id", "h", *[f"n_{k}" for k in BASE_KINDS], "base_sha256", *[f"n_{k}" for k in LEARNED_KINDS], "spans",
               "span_list"]

    def accepted(c: dict) -> bool:
        bias, weights = models[c["kind"]]
        return bias + sum(weights.get(f, 0.0) for f in c["features"]) > 0

    span_t = pa.list_(pa.struct([("kind", pa.string()), ("s", pa.int64()), ("e", pa.int64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            counts, sha, learned, spans, lists = [], [], [], [], []
            for base, found in zip(b.column("base").to_pylist(), b.column("found").to_pylist(), strict=True):
                own = [(x["kind"], x["s"], x["e"]) for x in base or ()]
                more = [(c["kind"], c["s"], c["e"]) for c in found or () if accepted(c)]
                text = ",".join(f"{KINDS[k]}:{s}:{e}" for k, s, e in sorted(own))
                counts.append([sum(k == j for k, _, _ in own) for j in range(len(BASE_KINDS))])
                sha.append(hashlib.sha256(text.encode()).hexdigest())
                learned.append([sum(k == j for k, _, _ in more) for j in (SECRET, NAME, ID)])
                spans.append(",".join(f"{KINDS[k]}:{s}:{e}" for k, s, e in sorted(own + more)))
                lists.append([{"kind": KINDS[k], "s": s, "e": e} for k, s, e in sorted(own + more)])
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), b.column("h"),
                 *[pa.array([c[j] for c in counts], pa.int64()) for j in range(len(BASE_KINDS))],
                 pa.array(sha, pa.string()), *[pa.array([c[j] for c in learned], pa.int64()) for j in range(len(LEARNED_KINDS))],
                 pa.array(spans, pa.string()), pa.array(lists, span_t)], names=columns)
    return run


def find_pii(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id, h (hash of the text), n_email, n_ip,
    n_card, n_phone, base_sha256, n_secret, n_name, n_id, spans ("kind:start:end", by kind and
    start, comma-joined; code points, end exclusive) and span_list (the same, typed).

    A null text counts as empty: no spans, the digest of the empty string. Rows
    that repeat an id or have none are searched like all others. Other columns
    are ignored. An empty table, or one without any candidate, trains no model
    and keeps the base spans only.
    """
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(F.col(text_col)).alias("h"),
                        F.col(text_col).alias("text"))
    scanned = staged(arrow_map(texts, _scan, _SCAN), "pii_scan")
    patterns = scanned.select(F.explode("found").alias("c")).groupBy("c.kind", "c.pattern").count().collect()
    prob = {k: expectation_maximisation({r[1]: r[2] for r in patterns if r[0] == k})  # at most 3**7 rows a kind
            for k in (SECRET, NAME, ID)}
    rows = (arrow_map(scanned.filter(F.size("found") > 0).select("found"), _soft(prob),
                      "kind int, feature int, pos long, n long")
            .groupBy("kind", "feature").agg(F.sum("pos"), F.sum("n")).collect())  # at most 16 per feature
    models = {k: naive_bayes(sorted((r[1], r[2], r[3]) for r in rows if r[0] == k)) for k in (SECRET, NAME, ID)}
    return arrow_map(
        scanned, _decide(models),
        "doc_id long, h long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, n_secret long, "
        "n_name long, n_id long, spans string, span_list array<struct<kind:string,s:long,e:long>>")


def _mask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        out = []
        for text, spans in zip(b.column("text").to_pylist(), b.column("span_list").to_pylist(), strict=True):
            if text is not None and spans:
                parts, end = [], 0
                for s in sorted(spans, key=lambda x: (x["s"], -x["e"])):
                    if s["s"] >= end:
                        parts += [text[end:s["s"]], f"<{s['kind'].upper()}>"]
                    end = max(end, s["e"])
                text = "".join([*parts, text[end:]])
            out.append(text)
        yield b.drop_columns(["text", "span_list"]).append_column("text", pa.array(out, pa.string()))


def mask_pii(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` (same columns) with every span replaced by its kind in angle
    brackets; overlapping spans become one. Null texts stay null; rows without
    an id are masked as well."""
    found = (find_pii(docs, id_col, text_col).filter("spans != ''")
             .select(F.col("doc_id").alias("k0"), F.col("h").alias("k1"), "span_list").dropDuplicates(["k0", "k1"]))
    cols = docs.columns
    packed = docs.select(
        F.struct(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(cols) if c != text_col]).alias("rest"),
        F.col(f"`{id_col}`").cast("long").alias("k0"), F.xxhash64(F.col(f"`{text_col}`")).alias("k1"),
        F.col(f"`{text_col}`").alias("text"))
    joined = packed.join(found, packed.k0.eqNullSafe(found.k0) & (packed.k1 == found.k1), "left").select(
        "rest", "text", "span_list")
    rest = packed.schema["rest"].dataType.simpleString()
    masked = arrow_map(joined, _mask, f"rest {rest}, text string")
    return masked.select(*[(F.col("text") if c == text_col else F.col(f"rest.c{i}")).alias(c)
                           for i, c in enumerate(cols)])
