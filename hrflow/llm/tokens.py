"""Words and word shingles of a batch of texts as 64-bit hashes, without a Python string per word.

A batch is the UTF-8 buffer of an Arrow string column. Words are maximal runs of bytes
other than space, tab, line feed, vertical tab, form feed and carriage return; A-Z are
lower-cased. The hash of a word is a polynomial over its bytes, read off prefix sums, and
then mixed; buffers are worked on in pieces of ``PIECE`` bytes, so a text of any length
needs a bounded amount of memory beyond its own words.
"""

from __future__ import annotations

import functools
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

PIECE = 1 << 17
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)


def mix64(x: np.ndarray) -> np.ndarray:
    """Bijective finaliser on uint64 (a copy)."""
    x = x ^ (x >> np.uint64(30))
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_MARKS = _SPACE.copy()
_MARKS[[c for c in range(0x21, 0x7F) if not chr(c).isalnum()]] = True
_LOWER = np.arange(256)
_LOWER[ord("A"):ord("Z") + 1] += 32
_CODE = mix64(np.arange(1, 257, dtype=np.uint64) * np.uint64(_BASE))[_LOWER]
_SHINGLE = mix64(np.arange(1, 65, dtype=np.uint64) * np.uint64(0xD1B54A32D192ED03)) | np.uint64(1)


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, dtype=np.uint64)
    out[0] = 1
    return np.cumprod(out, dtype=np.uint64)


@functools.cache
def _usual_powers() -> tuple[np.ndarray, np.ndarray]:
    return _powers(_BASE, 2 * PIECE), _powers(_INVERSE, 2 * PIECE)


@dataclass
class Words:
    """Words of a batch in order: byte spans in ``buf``, row number, hash, hashes of leading bytes."""

    buf: np.ndarray
    offsets: np.ndarray
    start: np.ndarray
    end: np.ndarray
    doc: np.ndarray
    hash: np.ndarray
    lead: dict[int, np.ndarray]


def buffers(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and row offsets of a string column; NULL counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column.cast(pa.large_string()), "")
    _, offsets, data = column.buffers()
    off = np.frombuffer(offsets, dtype=np.int64)[column.offset:column.offset + len(column) + 1] if len(column) \
        else np.zeros(1, np.int64)
    buf = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
    return buf[off[0]:off[-1]], off - off[0]


def words(column: pa.Array, leads: tuple[int, ...] = (), plain: bool = False) -> Words:
    """Words of a string column. ``leads``: also hash the first k bytes of words that have more
    than k (0 for the others). ``plain``: ASCII marks part words too, and Latin-1 capitals are
    lower-cased."""
    buf, off = buffers(column)
    space = _SPACE
    if plain:
        space = _MARKS
        second = np.flatnonzero(buf[:-1] == 0xC3) + 1  # two-byte characters U+00C0 to U+00DE
        second = second[(buf[second] < 0x9F) & (buf[second] >= 0x80) & (buf[second] != 0x97)]
        buf = buf.copy()
        buf[second] += 0x20
    if not len(buf):
        none = np.zeros(0, np.int64)
        return Words(buf, off, none, none, none, np.zeros(0, np.uint64), {k: np.zeros(0, np.uint64) for k in leads})
    solid = ~space[buf]
    first = solid.copy()
    first[1:] &= ~solid[:-1]
    begins = off[:-1][off[1:] > off[:-1]]
    first[begins] = solid[begins]
    start = np.flatnonzero(first)
    last = solid.copy()
    last[:-1] &= ~solid[1:]
    ends = off[1:][off[1:] > off[:-1]] - 1
    last[ends] = solid[ends]
    end = np.flatnonzero(last) + 1
    doc = np.searchsorted(off, start, side="right") - 1
    out = np.zeros(len(start), np.uint64)
    lead = {k: np.zeros(len(start), np.uint64) for k in leads}
    up, down = _usual_powers()
    i = 0
    while i < len(start):
        j = max(i + 1, int(np.searchsorted(end, start[i] + PIECE, side="right")))
        base = start[i]
        piece = buf[base:end[j - 1]]
        if len(piece) > len(up):  # one very long word
            up, down = _powers(_BASE, len(piece)), _powers(_INVERSE, len(piece))
        total = np.zeros(len(piece) + 1, np.uint64)
        np.cumsum(_CODE[piece] * up[:len(piece)], out=total[1:])
        s, e = start[i:j] - base, end[i:j] - base
        out[i:j] = mix64((total[e] - total[s]) * down[s] + (e - s).astype(np.uint64))
        for k in leads:
            longer = e - s > k
            at = s[longer]
            h = np.zeros(j - i, np.uint64)
            h[longer] = mix64((total[at + k] - total[at]) * down[at] + np.uint64(1000 + k))
            lead[k][i:j] = h
        i = j
    return Words(buf, off, start, end, doc, out, lead)


def shingles(w: Words, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all k-word shingles and their row numbers, in order (repeats included).

    A row with fewer than k words, but at least one, gives its whole sequence as one shingle.
    """
    h, doc = w.hash, w.doc
    n = len(h)
    count = np.bincount(doc, minlength=len(w.offsets) - 1) if n else np.zeros(len(w.offsets) - 1, np.int64)
    parts, rows = [], []
    if n >= k:
        ok = np.flatnonzero(doc[:n - k + 1] == doc[k - 1:])
        total = np.full(len(ok), k, np.uint64)
        for j in range(k):
            total += h[ok + j] * _SHINGLE[j]
        parts.append(mix64(total))
        rows.append(doc[ok])
    at = np.concatenate([[0], np.cumsum(count)])[:-1]
    for short in range(1, k):
        few = np.flatnonzero(count == short)
        if len(few):
            total = np.full(len(few), short, np.uint64)
            for j in range(short):
                total += h[at[few] + j] * _SHINGLE[j]
            parts.append(mix64(total))
            rows.append(few)
    if not parts:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    hashes, rows = np.concatenate(parts), np.concatenate(rows)
    if len(parts) > 1:
        order = np.argsort(rows, kind="stable")
        hashes, rows = hashes[order], rows[order]
    return hashes, rows


def shingle_sets(column: pa.Array, k: int):
    """Row number and sorted distinct shingle hashes of each row with words."""
    for lo, hi in pieces_of_rows(column):
        hashes, rows = shingles(words(column.slice(lo, hi - lo)), k)
        cut = np.flatnonzero(np.diff(rows)) + 1
        bounds = np.concatenate([[0], cut, [len(rows)]]) if len(rows) else np.zeros(1, np.int64)
        for s, e in zip(bounds[:-1], bounds[1:]):
            part = np.sort(hashes[s:e])
            if len(part) > 1:
                keep = np.empty(len(part), bool)
                keep[0] = True
                np.not_equal(part[1:], part[:-1], out=keep[1:])
                part = part[keep]
            yield lo + int(rows[s]), part


def pieces_of_rows(column: pa.Array, size: int = 1 << 19):
    """Row ranges whose texts together have about ``size`` bytes (a longer text is a range of its own)."""
    _, off = buffers(column)
    n, lo = len(off) - 1, 0
    while lo < n:
        hi = max(lo + 1, int(np.searchsorted(off, off[lo] + size, side="right")) - 1)
        yield lo, min(hi, n)
        lo = hi
