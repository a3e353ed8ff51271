"""Word, line and shingle hashes of Arrow string columns, with numpy.

A word is a maximal run of bytes outside 0x20 and 0x09-0x0D; those bytes never
occur inside a multi-byte UTF-8 character, so this equals the pattern
``[^\\x20\\x09-\\x0D]+`` on the text. All hashes are 64 bits wide. Texts are
worked on in slices of about a megabyte, so memory does not follow the batch.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICE_BYTES = 1 << 20
_U = np.uint64
_BASE = 0x9E3779B97F4A7C15 | 5  # odd, 5 mod 8: full multiplicative order
_BASE_INV = pow(_BASE, -1, 1 << 64)

_rng = np.random.Generator(np.random.PCG64(20240229))
TABLE = _rng.integers(1, 1 << 63, 256, dtype=np.uint64) * _U(2) + _U(1)
SEP = np.zeros(256, bool)
SEP[[0x20, 9, 10, 11, 12, 13]] = True
WORD_TABLE = TABLE.copy()
WORD_TABLE[SEP] = 0
LOWER_TABLE = WORD_TABLE.copy()
LOWER_TABLE[65:91] = WORD_TABLE[97:123]
LINE_TABLE = TABLE.copy()
LINE_TABLE[10] = 0

_powers = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers 0..n of the base and of its inverse, modulo 2**64."""
    if len(_powers[0]) < n + 1:
        size = max(n + 1, 2 * len(_powers[0]), SLICE_BYTES + 4096)
        for k, base in enumerate((_BASE, _BASE_INV)):
            p = np.full(size, _U(base))
            p[0] = 1
            _powers[k] = np.multiply.accumulate(p)
    return _powers[0][:n + 1], _powers[1][:n + 1]


def mix(h: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (xor-shift and multiply)."""
    h = h ^ (h >> _U(32))
    h = h * _U(0xD6E8FEB86659FD93)
    h ^= h >> _U(29)
    h *= _U(0xC2B2AE3D27D4EB4F)
    h ^= h >> _U(32)
    return h


def text_slices(texts: pa.Array, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, bytes, offsets) of runs of rows.

    Every text is followed by one newline byte, so neither words nor lines
    cross rows; ``offsets`` has the start of each text and the total length.
    Null texts count as empty.
    """
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    texts = pc.fill_null(texts.cast(pa.large_string()), "")
    if len(texts) == 0:
        return
    sizes = np.concatenate([[0], np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False) + 1)])
    lo = 0
    while lo < len(texts):
        hi = max(lo + 1, int(np.searchsorted(sizes, sizes[lo] + limit, side="right")) - 1)
        part = pc.binary_join_element_wise(texts.slice(lo, hi - lo), pa.scalar("", pa.large_string()),
                                           pa.scalar("\n", pa.large_string()))
        _, offs, data = part.buffers()
        offs = np.frombuffer(offs, np.int64)[part.offset:part.offset + len(part) + 1]
        yield lo, hi, np.frombuffer(data, np.uint8)[offs[0]:offs[-1]], offs - offs[0]
        lo = hi


class Words:
    """Words of a slice: byte ranges, the row of each, and rows' word ranges."""

    def __init__(self, buf: np.ndarray, offs: np.ndarray):
        inside = (~SEP)[buf]
        step = np.diff(inside.view(np.int8), prepend=np.int8(0))
        self.buf, self.offs = buf, offs
        self.starts = np.flatnonzero(step == 1)
        self.ends = np.flatnonzero(step == -1)
        self.bounds = np.searchsorted(self.starts, offs)
        self.counts = np.diff(self.bounds)
        self.inside = inside

    def rows(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.counts)), self.counts)

    def hashes(self, table: np.ndarray = WORD_TABLE) -> np.ndarray:
        return range_hashes(self.buf, self.starts, table)


def range_hashes(buf: np.ndarray, starts: np.ndarray, table: np.ndarray) -> np.ndarray:
    """Hash of the bytes from each start up to the next one; bytes whose table
    entry is 0 (separators) add nothing."""
    if not len(starts):
        return np.zeros(0, np.uint64)
    up, down = _power_tables(len(buf))
    return mix(np.add.reduceat(table[buf] * up[:len(buf)], starts) * down[starts])


def windows(h: np.ndarray, counts: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all runs of ``k`` consecutive words within a row, and the
    position of each run's first word. Rows with fewer words have none."""
    n = len(h) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    s = h[:n].copy()
    for j in range(1, k):
        s *= _U(0x9FB21C651E98DF25)
        s += h[j:j + n]
    left = np.repeat(np.cumsum(counts), counts) - np.arange(len(h))  # words to the row's end
    at = np.flatnonzero(left[:n] >= k)
    return mix(s[at]), at


def sequence_hash(h: np.ndarray) -> np.uint64:
    """Hash of a whole short word sequence (also of its length)."""
    s = _U(len(h))
    with np.errstate(over="ignore"):
        for x in h:
            s = s * _U(0x9FB21C651E98DF25) + x
    return mix(np.array([s]))[0]


def shingle_rows(texts: pa.Array, k: int, table: np.ndarray = LOWER_TABLE) -> Iterator[tuple[int, np.ndarray]]:
    """(row, sorted distinct shingle hashes) for every text.

    Shingles are runs of ``k`` words; with fewer words the whole sequence is
    the one shingle; without words the set is empty.
    """
    for lo, hi, buf, offs in text_slices(texts):
        w = Words(buf, offs)
        h = w.hashes(table)
        s, at = windows(h, w.counts, k)
        cut = np.searchsorted(at, w.bounds)
        for r in range(hi - lo):
            n = w.counts[r]
            if n >= k:
                yield lo + r, np.unique(s[cut[r]:cut[r + 1]])
            elif n:
                yield lo + r, np.array([sequence_hash(h[w.bounds[r]:w.bounds[r + 1]])])
            else:
                yield lo + r, np.zeros(0, np.uint64)


def signed(h: np.ndarray) -> np.ndarray:
    """The same 64 bits as Spark's long."""
    return h.view(np.int64)


def sorted_groups(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """Groups of equal keys of a stream whose rows are sorted by them."""
    held: list[pa.RecordBatch] = []
    last = None
    for b in batches:
        if not b.num_rows:
            continue
        cols = [b.column(k).to_numpy(zero_copy_only=False) for k in keys]
        change = np.zeros(b.num_rows - 1, bool)
        for c in cols:
            change |= c[1:] != c[:-1]
        cuts = [0, *(np.flatnonzero(change) + 1).tolist(), b.num_rows]
        for lo, hi in zip(cuts[:-1], cuts[1:], strict=True):
            key = tuple(c[lo] for c in cols)
            if held and key != last:
                yield pa.Table.from_batches(held)
                held = []
            held.append(b.slice(lo, hi - lo))
            last = key
    if held:
        yield pa.Table.from_batches(held)
