"""SentencePiece-compatible merge encoding with seeded merge-dropout, and decoding.

A text gets one space in front; spaces become the piece mark; each chunk (marks
and the characters after them) starts as single characters. An agenda holds
all neighbouring pairs that join to a known piece, best score first, then
leftmost. Every candidate taken from the agenda is skipped with probability
``dropout``, decided by a hash of the key, its place and the piece it would
make; otherwise the pair is joined and its new neighbours enter the agenda.
Characters without a piece become byte pieces, a mark that stands in the text
itself too, so decoding returns the text exactly.

Every occurrence of a chunk has a key of its own: a hash of the seed, the
document and the chunk's number. What is kept, within bounded memory, are a
chunk's courses: the candidates that its agenda takes when none is skipped,
and what follows when one of them is. An occurrence hashes the candidates of
its course; where the first one is skipped it goes over to the course that
follows from there, so its pieces are those of its own agenda. New courses of
a batch are worked off together: in each round every agenda takes its best
candidate, so the order within a chunk is the same as alone.
"""

from __future__ import annotations

import heapq
import re
import zlib
from array import array
from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sluice.llm._stage import arrow_map
from sluice.llm._text import mix

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
DROPOUT = 0.1
SEED = 20240229
MARK = "▁"
COURSES = 1_000_000  # kept per worker
LONG_CHUNK = 64  # longer ones are encoded alone and not kept
DOCS_AT_ONCE, CHARS_AT_ONCE = 512, 1 << 21  # of a portion, whichever is reached first
_NONE = np.uint64(0xFFFFFFFFFFFFFFFF)
_M64 = (1 << 64) - 1


@dataclass
class Pieces:
    """What encoding and decoding need of a model: pieces, ranks, byte pieces."""

    texts: list[str]
    ranks: dict[str, int]  # piece -> order of its score, best first
    ids: dict[str, int]
    byte_ids: list[int]
    byte_of: dict[int, int]
    chunk: re.Pattern = field(init=False)
    name: int = field(init=False)
    blobs: list[bytes] = field(init=False)  # what each piece decodes to

    def __post_init__(self):
        # Chunks may be cut before a mark that follows another character, and
        # around newlines, if no piece reaches across.
        whole = any(MARK in p.lstrip(MARK) for p in self.ids) or any("\n" in p for p in self.ids)
        self.chunk = re.compile(rf"[^{MARK}]+|{MARK}" if whole else rf" *[^ \n{MARK}]+|\n| +|{MARK}")
        self.name = zlib.crc32("\n".join(self.texts).encode())
        self.blobs = [bytes([self.byte_of[i]]) if i in self.byte_of else t.replace(MARK, " ").encode()
                      for i, t in enumerate(self.texts)]


def load_pieces(model: str = MODEL) -> Pieces:
    """Reads a SentencePiece model file on the driver."""
    import sentencepiece
    sp = sentencepiece.SentencePieceProcessor(model_file=model)
    texts, ids, scores, byte_ids, byte_of = [], {}, {}, [0] * 256, {}
    for i in range(sp.get_piece_size()):
        p = sp.id_to_piece(i)
        texts.append(p)
        if sp.is_byte(i):
            byte_ids[int(p[3:5], 16)] = i
            byte_of[i] = int(p[3:5], 16)
        elif not (sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i)):
            ids[p], scores[p] = i, sp.get_score(i)
    order = sorted(ids, key=lambda p: (-scores[p], ids[p]))
    return Pieces(texts, {p: k for k, p in enumerate(order)}, ids, byte_ids, byte_of)


def _skipped(key: int, place: int, piece: int, limit: int) -> bool:
    x = (key ^ (place * 0x9E3779B97F4A7C15) ^ (piece * 0xC2B2AE3D27D4EB4F)) & _M64
    x = ((x ^ (x >> 32)) * 0xD6E8FEB86659FD93) & _M64
    x = ((x ^ (x >> 29)) * 0x9FB21C651E98DF25) & _M64
    return (x >> 32) < limit


def encode_chunk(chunk: str, pieces: Pieces, key: int, dropout: float, barred: frozenset = frozenset(),
                 taken: list | None = None) -> list[int]:
    """Piece ids of one chunk; ``chunk`` has spaces, not marks. Candidates
    (place, rank) in ``barred`` are skipped; ``taken`` gets those joined."""
    if chunk == MARK:
        return [pieces.byte_ids[x] for x in chunk.encode()]
    # The mark itself is safe as a stand-in: a chunk never holds one from the text.
    parts: list[str | None] = list(chunk.replace(" ", MARK))
    n = len(parts)
    ranks, limit = pieces.ranks, int(dropout * (1 << 32))
    left, right = list(range(-1, n - 1)), list(range(1, n + 1))
    agenda = []
    for i in range(n - 1):
        r = ranks.get(parts[i] + parts[i + 1])
        if r is not None:
            agenda.append((r, i, i + 1, len(parts[i]) + len(parts[i + 1])))
    heapq.heapify(agenda)
    while agenda:
        r, i, j, size = heapq.heappop(agenda)
        a, b = parts[i], parts[j]
        if a is None or b is None or right[i] != j or len(a) + len(b) != size:
            continue  # one of the two has been joined meanwhile
        if (i, r) in barred or (limit and _skipped(key, i, r, limit)):
            continue
        if taken is not None:
            taken.append((i, r))
        parts[i], parts[j] = a + b, None
        k = right[i] = right[j]
        if k < n:
            left[k] = i
            r = ranks.get(parts[i] + parts[k])
            if r is not None:
                heapq.heappush(agenda, (r, i, k, size + len(parts[k])))
        k = left[i]
        if k >= 0:
            r = ranks.get(parts[k] + parts[i])
            if r is not None:
                heapq.heappush(agenda, (r, k, i, size + len(parts[k])))
    out = []
    for p in parts:
        if p is not None:
            i = pieces.ids.get(p)
            if i is not None:
                out.append(i)
            else:
                out.extend(pieces.byte_ids[x] for x in p.encode())
    return out


class Joins:
    """Which pairs of pieces join to a piece, as a hash table of numpy arrays."""

    def __init__(self, pieces: Pieces):
        self.order = np.array(sorted(pieces.ids, key=pieces.ranks.get), object)
        self.id_of_rank = np.array([pieces.ids[p] for p in self.order], np.int32)
        ranks = pieces.ranks
        self.char = np.full(0x110000, -1, np.int32)
        for p, r in ranks.items():
            if len(p) == 1:
                self.char[ord(p)] = r
        self.char[ord(" ")] = self.char[ord(MARK)]
        pairs = [(ranks[p[:k]], ranks[p[k:]], r) for p, r in ranks.items() for k in range(1, len(p))
                 if p[:k] in ranks and p[k:] in ranks]
        a, b, r = (np.array(x, np.int64) for x in zip(*pairs, strict=True)) if pairs else [np.zeros(0, np.int64)] * 3
        keys = (a << 32 | b).view(np.uint64)
        self.bits = max(4, int(len(keys) * 4).bit_length())
        self.keys = np.full((1 << self.bits) + 64, _NONE, np.uint64)
        self.ranks = np.zeros(len(self.keys), np.int64)
        self.probes = 0
        left = np.arange(len(keys))
        while len(left):  # linear probing, one step for all that have no place yet
            slot = self._slot(keys[left]) + self.probes
            free = self.keys[slot] == _NONE
            _, first = np.unique(slot, return_index=True)
            won = np.zeros(len(left), bool)
            won[first] = True
            won &= free
            self.keys[slot[won]], self.ranks[slot[won]] = keys[left[won]], r[left[won]]
            left = left[~won]
            self.probes += 1
            if self.probes >= 64 and len(left):
                raise ValueError("the piece table is too dense")

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return (mix(keys) >> np.uint64(64 - self.bits)).astype(np.int64)

    def find(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Rank of the piece that a pair joins to, or -1."""
        keys = (a.astype(np.int64) << 32 | b).view(np.uint64)
        out = np.full(len(keys), -1, np.int64)
        open_ = np.flatnonzero((a >= 0) & (b >= 0))
        slot = self._slot(keys[open_])
        for step in range(self.probes):
            there = self.keys[slot + step]
            hit = there == keys[open_]
            out[open_[hit]] = self.ranks[slot[hit] + step]
            go = ~hit & (there != _NONE)
            open_, slot = open_[go], slot[go]
            if not len(open_):
                break
        return out


def _code(chunk: np.ndarray, place: np.ndarray, rank: np.ndarray) -> np.ndarray:
    """One number for a candidate of a batch; places are below ``LONG_CHUNK``."""
    return (chunk * LONG_CHUNK + place) << 24 | rank


def encode_chunks(chunks: list[str], keys: np.ndarray, pieces: Pieces, joins: Joins, dropout: float,
                  barred: np.ndarray | None = None, taken: list | None = None) -> list[bytes]:
    """Piece ids (int32 bytes) of chunks, each with its key; as ``encode_chunk``.

    Candidates whose code (``_code``) is in the sorted ``barred`` are skipped;
    ``taken`` gets the (chunks, places, ranks) joined in every round.
    """
    text = "".join(chunks)
    sym = joins.char[np.frombuffer(text.encode("utf-32-le"), np.uint32)]
    size = np.array([len(c) for c in chunks])
    ends = np.cumsum(size)
    starts = ends - size
    n = len(sym)
    place = np.arange(n) - np.repeat(starts, size)
    key = np.repeat(keys, size)
    of = np.repeat(np.arange(len(chunks)), size)
    nxt, prv = np.arange(1, n + 1), np.arange(-1, n - 1)
    nxt[ends - 1] = -1
    prv[starts] = -1
    limit = np.uint64(int(dropout * (1 << 32)))

    def agenda(at: np.ndarray) -> np.ndarray:
        """Rank and place of the candidates that start at ``at``; none if skipped."""
        r = joins.find(sym[at], np.where(nxt[at] >= 0, sym[nxt[at]], -1))
        out = np.where(r >= 0, (r.astype(np.uint64) << np.uint64(32)) | at.astype(np.uint64), _NONE)
        if limit:
            x = (key[at] ^ (place[at].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
                 ^ (r.astype(np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F)))
            x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
            x = (x ^ (x >> np.uint64(29))) * np.uint64(0x9FB21C651E98DF25)
            out[(x >> np.uint64(32)) < limit] = _NONE
        if barred is not None and len(barred):
            code = _code(of[at], place[at], np.maximum(r, 0))
            out[barred[np.minimum(np.searchsorted(barred, code), len(barred) - 1)] == code] = _NONE
        return out

    alive = np.ones(n, bool)
    todo = agenda(np.arange(n))
    while True:
        best = np.minimum.reduceat(todo, starts)
        best = best[best != _NONE]
        if not len(best):
            break
        i = (best & np.uint64(0xFFFFFFFF)).astype(np.int64)
        j = nxt[i]
        if taken is not None:
            taken.append((of[i], place[i], (best >> np.uint64(32)).astype(np.int64)))
        sym[i] = (best >> np.uint64(32)).astype(np.int32)
        alive[j] = False
        todo[j] = _NONE
        k = nxt[i] = nxt[j]
        prv[k[k >= 0]] = i[k >= 0]
        todo[i] = agenda(i)
        before = prv[i]
        before = before[before >= 0]
        todo[before] = agenda(before)
    ids = joins.id_of_rank[sym[alive]]
    cut = np.concatenate([[0], np.cumsum(np.add.reduceat(alive, starts, dtype=np.int64))]) * 4
    flat = ids.tobytes()
    return [flat[a:b] for a, b in zip(cut[:-1].tolist(), cut[1:].tolist(), strict=True)]


def _ranges(starts: np.ndarray, size: np.ndarray) -> np.ndarray:
    """All positions of the ranges, one range after the other."""
    return np.arange(int(size.sum())) - np.repeat(np.cumsum(size) - size, size) + np.repeat(starts, size)


class Sampler:
    """Encodes texts with a key for every occurrence of a chunk, keeping a
    bounded number of courses."""

    def __init__(self, pieces: Pieces, dropout: float, seed: int):
        self.pieces, self.joins = pieces, Joins(pieces)
        self.dropout, self.limit, self.seed = dropout, np.uint64(int(dropout * (1 << 32))), np.uint64(seed)
        self._clear()

    def _clear(self) -> None:
        self.roots: dict[str, int] = {}  # chunk -> its course without a skip
        self.turns: dict[int, int] = {}  # course << 8 | number of the candidate skipped -> course
        self.chunk: list[str] = []
        self.n = 0
        # Per course: the one it follows from, and the skipped candidate's place in the flat arrays (-1: none).
        self.skip_of, self.skip_at = (np.zeros(1 << 16, np.int64) for _ in range(2))
        # Per course: its candidates and ids in the flat arrays.
        self.cand_at, self.cand_n, self.id_at, self.id_n = (np.zeros(1 << 16, np.int64) for _ in range(4))
        self.place, self.rank, self.ids = (np.zeros(1 << 18, np.int32) for _ in range(3))
        self.mark = np.zeros(1 << 18, np.uint64)  # what ``_skipped`` mixes into the key
        self.n_cand = self.n_id = 0

    @staticmethod
    def _grown(x: np.ndarray, n: int) -> np.ndarray:
        return x if n <= len(x) else np.concatenate([x, np.zeros(max(n - len(x), len(x)), x.dtype)])

    def _barred(self, course: np.ndarray, cand: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(number, place, rank) of every candidate and of those that its course has skipped before."""
        k = np.flatnonzero(cand >= 0)
        course, cand = course[k], cand[k]
        found = [(k, cand)]
        while len(k):
            course, cand = self.skip_of[course], self.skip_at[course]
            go = cand >= 0
            k, course, cand = k[go], course[go], cand[go]
            found.append((k, cand))
        k, cand = (np.concatenate(x) for x in zip(*found, strict=True))
        return k, self.place[cand].astype(np.int64), self.rank[cand].astype(np.int64)

    def _add(self, new: list[str], skip_of: np.ndarray, skip_at: np.ndarray) -> None:
        """Works off the courses of chunks; each follows ``skip_of`` up to the
        candidate ``skip_at``, which it skips (-1: none)."""
        codes = np.frombuffer("".join(new).encode("utf-32-le"), np.uint32)
        size = np.fromiter(map(len, new), np.int64, len(new))
        odd = np.logical_or.reduceat(self.joins.char[codes] < 0, np.cumsum(size) - size)  # needs byte pieces
        odd |= (size == 1) & (codes[np.cumsum(size) - size] == ord(MARK))
        plain = np.flatnonzero(~odd)
        of, at, which = self._barred(skip_of, skip_at)
        rounds: list = []
        ids: list = [b""] * len(new)
        if len(plain):
            mine = ~odd[of]
            barred = np.sort(_code((np.cumsum(~odd) - 1)[of[mine]], at[mine], which[mine]))
            done = encode_chunks([new[x] for x in plain.tolist()], np.zeros(len(plain), np.uint64), self.pieces,
                                 self.joins, 0.0, barred, rounds)
            for x, b in zip(plain.tolist(), done, strict=True):
                ids[x] = b
            rounds = [(plain[c], i, r) for c, i, r in rounds]
        skipped: dict[int, set[tuple[int, int]]] = {}
        for x, i, r in zip(*(v[odd[of]].tolist() for v in (of, at, which)), strict=True):
            skipped.setdefault(x, set()).add((i, r))
        for x in np.flatnonzero(odd).tolist():
            taken: list = []
            ids[x] = array("i", encode_chunk(new[x], self.pieces, 0, 0.0, frozenset(skipped.get(x, ())),
                                             taken)).tobytes()
            if taken:
                i, r = np.array(taken, np.int64).T
                rounds.append((np.full(len(i), x), i, r))
        none = np.zeros(0, np.int64)
        of, i, r = (np.concatenate(x) for x in zip(*rounds, strict=True)) if rounds else (none, none, none)
        order = np.argsort(of, kind="stable")
        n, count = self.n + len(new), np.bincount(of, minlength=len(new))
        lengths = np.fromiter(map(len, ids), np.int64, len(ids)) // 4
        self.cand_at, self.cand_n, self.id_at, self.id_n, self.skip_of, self.skip_at = (
            self._grown(x, n) for x in (self.cand_at, self.cand_n, self.id_at, self.id_n, self.skip_of, self.skip_at))
        self.skip_of[self.n:n], self.skip_at[self.n:n] = skip_of, skip_at
        self.cand_n[self.n:n], self.cand_at[self.n:n] = count, self.n_cand + np.cumsum(count) - count
        self.id_n[self.n:n], self.id_at[self.n:n] = lengths, self.n_id + np.cumsum(lengths) - lengths
        m = self.n_cand + len(of)
        self.place, self.rank, self.mark = (self._grown(x, m) for x in (self.place, self.rank, self.mark))
        i, r = i[order], r[order]
        self.place[self.n_cand:m], self.rank[self.n_cand:m] = i, r
        self.mark[self.n_cand:m] = (i.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
                                    ^ r.astype(np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F))
        k = self.n_id + int(lengths.sum())
        self.ids = self._grown(self.ids, k)
        self.ids[self.n_id:k] = np.frombuffer(b"".join(ids), np.int32)
        self.n, self.n_cand, self.n_id = n, m, k
        self.chunk += new

    def _keys(self, n: int, doc: int) -> np.ndarray:
        """The keys of a document's ``n`` chunks."""
        place = np.arange(n, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        with np.errstate(over="ignore"):
            return mix(place + (np.uint64(doc & _M64) * np.uint64(0xC2B2AE3D27D4EB4F) + self.seed))

    def _followed(self, course: np.ndarray, key: np.ndarray) -> np.ndarray:
        """The course that every occurrence ends on."""
        course = course.copy()
        todo, at = np.arange(len(course)) if self.limit else np.zeros(0, np.int64), np.zeros(len(course), np.int64)
        while len(todo):
            c = course[todo]
            size = self.cand_n[c] - at
            some = size > 0
            todo, c, at, size = todo[some], c[some], at[some], size[some]
            if not len(todo):
                break
            cand = _ranges(self.cand_at[c] + at, size)
            x = np.repeat(key[todo], size)
            x ^= self.mark[cand]
            x ^= x >> np.uint64(32)
            x *= np.uint64(0xD6E8FEB86659FD93)
            x ^= x >> np.uint64(29)
            x *= np.uint64(0x9FB21C651E98DF25)
            skip = np.flatnonzero((x >> np.uint64(32)) < self.limit)
            row = np.repeat(np.arange(len(todo)), size)[skip]
            row, first = np.unique(row, return_index=True)
            f = (skip[first] - (np.cumsum(size) - size)[row]) + at[row]
            todo, c, at = todo[row], c[row], f
            turn, back = np.unique(c << 8 | f, return_inverse=True)
            after = np.fromiter(map(self.turns.get, turn.tolist(), repeat(-1)), np.int64, len(turn))
            fresh = np.flatnonzero(after < 0)
            if len(fresh):
                t = turn[fresh]
                after[fresh] = np.arange(self.n, self.n + len(t))
                self._add([self.chunk[p] for p in (t >> 8).tolist()], t >> 8, self.cand_at[t >> 8] + (t & 255))
                self.turns.update(zip(t.tolist(), after[fresh].tolist(), strict=True))
            course[todo] = after[back]
        return course

    def encode_all(self, texts: list[str], docs: list[int]) -> list[np.ndarray]:
        if self.n > COURSES:
            self._clear()
        split = [self.pieces.chunk.findall(" " + t) if t else [] for t in texts]
        chunks = [c for x in split for c in x]
        if not chunks:
            return [np.zeros(0, np.int32) for _ in texts]
        key = np.concatenate([self._keys(len(x), d) for x, d in zip(split, docs, strict=True)])
        course = np.fromiter(map(self.roots.get, chunks, repeat(-1)), np.int64, len(chunks))
        unknown = np.flatnonzero(course < 0).tolist()
        new = [c for c in {chunks[x] for x in unknown} if len(c) <= LONG_CHUNK]
        if new:
            first = self.n
            none = np.full(len(new), -1)
            self._add(new, none, none)
            self.roots.update(zip(new, range(first, self.n), strict=True))
            course[unknown] = [self.roots.get(chunks[x], -1) for x in unknown]
        short = np.flatnonzero(course >= 0)
        course[short] = self._followed(course[short], key[short])
        size = np.where(course >= 0, self.id_n[course], 0)
        alone = {x: np.array(encode_chunk(chunks[x], self.pieces, int(key[x]), self.dropout), np.int32)
                 for x in np.flatnonzero(course < 0).tolist()}
        for x, ids in alone.items():
            size[x] = len(ids)
        ends = np.cumsum(size)
        flat = np.empty(int(ends[-1]), np.int32)
        flat[_ranges((ends - size)[short], size[short])] = self.ids[_ranges(self.id_at[course[short]], size[short])]
        for x, ids in alone.items():
            flat[ends[x] - size[x]:ends[x]] = ids
        cut = np.concatenate([[0], ends])[np.cumsum([0, *map(len, split)])]
        return [flat[a:b] for a, b in zip(cut[:-1].tolist(), cut[1:].tolist(), strict=True)]


def decode_ids(ids, pieces: Pieces) -> str:
    """The text that ``ids`` encode. A piece starts with a whole character, so
    bytes that make none are replaced up to the next piece, not beyond."""
    ids = ids.tolist() if isinstance(ids, np.ndarray) else ids
    return b"".join(map(pieces.blobs.__getitem__, ids)).decode("utf-8", "replace")[1:]


def portions(sizes: list[int]) -> Iterator[tuple[int, int]]:
    """Ranges of texts of at most ``DOCS_AT_ONCE``, and of ``CHARS_AT_ONCE`` but for a single one."""
    lo = held = 0
    for hi, size in enumerate(sizes):
        if hi > lo and (hi - lo == DOCS_AT_ONCE or held + size > CHARS_AT_ONCE):
            yield lo, hi
            lo, held = hi, 0
        held += size
    if sizes:
        yield lo, len(sizes)


_samplers: dict[tuple, Sampler] = {}  # one per setting and worker process


def _encode(pieces: Pieces, dropout: float, seed: int):
    setting = (pieces.name, dropout, seed)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if setting not in _samplers:
            _samplers[setting] = Sampler(pieces, dropout, seed)
        enc = _samplers[setting]
        for b in batches:
            for lo, hi in portions([len(t) if t else 0 for t in b.column("text").to_pylist()]):
                part = b.slice(lo, hi - lo)
                texts = [t or "" for t in part.column("text").to_pylist()]
                each = enc.encode_all(texts, [i or 0 for i in part.column("doc_id").to_pylist()])
                lossless = [decode_ids(x, pieces) == t for x, t in zip(each, texts, strict=True)]
                ends = np.concatenate([[0], np.cumsum([len(x) for x in each])])
                ids = pa.ListArray.from_arrays(pa.array(ends, pa.int32()),
                                               pa.array(np.concatenate([np.zeros(0, np.int32), *each])))
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), ids, pa.array(np.diff(ends), pa.int64()), pa.array(lossless)],
                    names=["doc_id", "ids", "n_pieces", "lossless"])
    return run


def _decode(pieces: Pieces):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = [None if x is None else decode_ids(x, pieces) for x in b.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(texts, pa.string())],
                                             names=["doc_id", "text"])
    return run


def encode(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", model: str = MODEL,
           dropout: float = DROPOUT, seed: int = SEED) -> DataFrame:
    """(doc_id, ids, n_pieces, lossless) for every row of ``docs``.

    The model file is read on the driver, at the path given, and travels to
    the tasks with the function. With ``dropout`` 0 the segmentation is the
    model's own. Dropout is drawn for every occurrence of a chunk by itself. A
    null or empty text has no pieces. Rows that repeat an id and text are encoded alike; a row without an id uses key 0. ``lossless``
    says that decoding gives the text back (null as empty). Other columns are
    ignored. An empty table gives an empty result.
    """
    base = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return arrow_map(base, _encode(load_pieces(model), dropout, seed),
                     "doc_id long, ids array<int>, n_pieces long, lossless boolean")


def decode(encoded: DataFrame, id_col: str = "doc_id", ids_col: str = "ids", model: str = MODEL) -> DataFrame:
    """(doc_id, text) of encoded rows; a null list gives a null text."""
    base = encoded.select(F.col(id_col).cast("long").alias("doc_id"), F.col(ids_col).alias("ids"))
    return arrow_map(base, _decode(load_pieces(model)), "doc_id long, text string")
