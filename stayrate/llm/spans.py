"""Vectorised word spans and hashes over UTF-8 text buffers (numpy).

The functions work on one buffer of concatenated texts plus text offsets, as
Arrow string arrays store them, so a batch of documents is cut into words and
hashed without a Python object per word.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

#: The six white-space bytes of the word class ``[^\x20\x09-\x0D]+``.
SPACE = np.zeros(256, bool)
SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True

_BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
_BASE_INV = np.uint64(pow(int(_BASE), -1, 1 << 64))
#: Text bytes handled at a time inside a task.
CHUNK_BYTES = 2 << 20
_powers = (np.ones(1, np.uint64), np.ones(1, np.uint64))


def text_buffer(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets (n + 1) of a string column; null counts as empty."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    if col.null_count:
        col = col.fill_null("")
    n = len(col)
    if n == 0:
        return np.empty(0, np.uint8), np.zeros(1, np.int64)
    width = np.int64 if pa.types.is_large_string(col.type) else np.int32
    offs = np.frombuffer(col.buffers()[1], width)[col.offset:col.offset + n + 1].astype(np.int64)
    raw = col.buffers()[2]
    data = np.frombuffer(raw, np.uint8) if raw is not None else np.empty(0, np.uint8)
    return data[offs[0]:offs[-1]], offs - offs[0]


def chunks(offs: np.ndarray, limit: int = CHUNK_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges of at most ``limit`` bytes (a longer text stands alone)."""
    lo, n = 0, len(offs) - 1
    while lo < n:
        hi = max(lo + 1, int(np.searchsorted(offs, offs[lo] + limit, "right")) - 1)
        yield lo, min(hi, n)
        lo = min(hi, n)


def byte_set(*members: int | range) -> np.ndarray:
    """A table of 256 flags."""
    t = np.zeros(256, bool)
    for m in members:
        t[list(m) if isinstance(m, range) else m] = True
    return t


def per_text(flags: np.ndarray, offs: np.ndarray) -> np.ndarray:
    """Number of set flags in each text."""
    total = np.concatenate([[0], np.cumsum(flags, dtype=np.int64)])
    return total[offs[1:]] - total[offs[:-1]]


def word_spans(data: np.ndarray, offs: np.ndarray,
               gaps: np.ndarray = SPACE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(starts, ends, text) of every word; words end at bytes of ``gaps`` and with their text."""
    if len(data) == 0:
        e = np.empty(0, np.int64)
        return e, e, e
    word = ~gaps[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[offs] = True
    before = np.empty_like(word)
    before[0] = False
    before[1:] = word[:-1]
    before &= ~edge[:-1]
    starts = np.flatnonzero(word & ~before)
    after = np.empty_like(word)
    after[-1] = False
    after[:-1] = word[1:]
    after &= ~edge[1:]
    ends = np.flatnonzero(word & ~after) + 1
    return starts, ends, np.searchsorted(offs, starts, "right") - 1


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    global _powers
    if len(_powers[0]) >= n:
        return _powers
    out = []
    for base in (_BASE, _BASE_INV):
        p = np.full(n, base, np.uint64)
        p[0] = 1
        out.append(np.cumprod(p, dtype=np.uint64))
    if n <= CHUNK_BYTES + (CHUNK_BYTES >> 2):
        _powers = (out[0], out[1])
    return out[0], out[1]


def mix64(h: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finalizer."""
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xFF51AFD7ED558CCD)
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(33))


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of ``data[start:end]`` per span (equal bytes, equal hash)."""
    up, down = _power_tables(len(data) + 1)
    total = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[:len(data)], out=total[1:])
    return mix64((total[ends] - total[starts]) * down[starts])


def window_hashes(h: np.ndarray, text: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the windows of ``n`` words inside one text, and their first word's index."""
    if len(h) < n:
        return np.empty(0, np.uint64), np.empty(0, np.int64)
    w = h[:len(h) - n + 1].copy()
    for k in range(1, n):
        w = mix64(w * np.uint64(0xD6E8FEB86659FD93) + h[k:len(h) - n + 1 + k])
    at = np.flatnonzero(text[:len(h) - n + 1] == text[n - 1:])
    return w[at], at
