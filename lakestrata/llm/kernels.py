"""Vectorised text kernels used inside Arrow tasks.

Every kernel works on a few megabytes of text at a time, whatever the size of
the Arrow batch, so the memory of a task is bounded by its longest document.
"""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator
from functools import wraps

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICE_BYTES = 1 << 19
U64 = np.uint64


def trimmed(run: Callable) -> Callable:
    """A task function that gives freed memory back to the system at its end.

    A Python worker stays for later tasks; what its allocators keep would add
    to the memory of every stage that follows."""

    @wraps(run)
    def out(batches):
        try:
            yield from run(batches)
        finally:
            pa.default_memory_pool().release_unused()
            trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc only
            if trim is not None:
                trim(0)

    return out


_BASE = 0x9E3779B97F4A7C15
_BASE_INV = pow(_BASE, -1, 1 << 64)
_powers: dict[int, np.ndarray] = {}

SPACE = np.zeros(256, dtype=bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def mix(x: np.ndarray) -> np.ndarray:
    """Bijective 64-bit finaliser."""
    x = x ^ (x >> U64(30))
    x = x * U64(0xBF58476D1CE4E5B9)
    x ^= x >> U64(27)
    x = x * U64(0x94D049BB133111EB)
    x ^= x >> U64(31)
    return x


def powers(base: int, n: int) -> np.ndarray:
    """base**0 .. base**(n-1) modulo 2**64 (the common size is kept)."""
    size = max(n, SLICE_BYTES + 1)
    kept = _powers.get(base)
    if kept is None or len(kept) < n:
        kept = np.full(size, base, dtype=U64)
        kept[0] = 1
        np.cumprod(kept, out=kept)
        if size <= 4 * SLICE_BYTES:
            _powers[base] = kept
    return kept[:n]


def text_buffers(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string column; null counts as empty."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    arr = pc.fill_null(col.cast(pa.large_string()), "")
    if len(arr) == 0 or arr.buffers()[1] is None:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    off = np.frombuffer(arr.buffers()[1], np.int64)[arr.offset : arr.offset + len(arr) + 1]
    data = np.frombuffer(arr.buffers()[2], np.uint8) if arr.buffers()[2] is not None else np.zeros(0, np.uint8)
    return data, off


def slices(col: pa.Array, budget: int = SLICE_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, bytes, offsets from 0) of at most ``budget`` bytes or one row."""
    data, off = text_buffers(col)
    i, n = 0, len(off) - 1
    while i < n:
        j = max(i + 1, int(np.searchsorted(off, off[i] + budget, "right")) - 1)
        yield i, j, data[off[i] : off[j]], off[i : j + 1] - off[i]
        i = j


def prefix_hash(data: np.ndarray) -> np.ndarray:
    """Prefix sums of (byte + 1) * base**position, modulo 2**64."""
    out = np.zeros(len(data) + 1, dtype=U64)
    np.cumsum((data.astype(U64) + U64(1)) * powers(_BASE, len(data)), out=out[1:])
    return out


def span_hash(prefix: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hash of each bytes[start:end], equal for equal bytes anywhere."""
    return mix((prefix[end] - prefix[start]) * powers(_BASE_INV, len(prefix))[start])


def spans(inside: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Maximal runs of marked bytes that do not cross rows: (start, end, row)."""
    n = len(inside)
    edge = np.zeros(n + 1, dtype=bool)
    edge[off] = True
    start, end = inside.copy(), inside.copy()
    start[1:] &= ~inside[:-1] | edge[1:n]
    end[:-1] &= ~inside[1:] | edge[1:n]
    s = np.flatnonzero(start)
    return s, np.flatnonzero(end) + 1, np.searchsorted(off, s, "right") - 1


def words(data: np.ndarray, off: np.ndarray, lower: bool = True) -> tuple[np.ndarray, np.ndarray]:
    """Hash and row of every word ``[^\\x20\\x09-\\x0D]+`` (A-Z lower-cased)."""
    if lower:
        data = LOWER[data]
    s, e, row = spans(~SPACE[data], off)
    return span_hash(prefix_hash(data), s, e), row


_LANES = [int(mix(np.array([i + 1], dtype=U64))[0]) | 1 for i in range(64)]


def ngrams(h: np.ndarray, row: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash and row of every window of n consecutive words of one row."""
    m = len(h) - n + 1
    if m <= 0:
        return np.zeros(0, U64), np.zeros(0, np.int64)
    acc = np.zeros(m, dtype=U64)
    for j in range(n):
        acc += h[j : j + m] * U64(_LANES[j])
    ok = row[:m] == row[n - 1 :]
    return mix(acc[ok]), row[:m][ok]


def shingle_sets(data: np.ndarray, off: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct sorted n-word shingle hashes of each row: (hashes, offsets by row).

    A row of fewer than n words has its whole word sequence as the one shingle;
    a row without words has none."""
    rows = len(off) - 1
    h, row = words(data, off)
    per = np.bincount(row, minlength=rows)
    g, grow = ngrams(h, row, n)
    few = np.flatnonzero((per > 0) & (per < n))
    if len(few):
        first = np.concatenate([[0], np.cumsum(per)])[few]
        acc = per[few].astype(U64) * U64(0xD6E8FEB86659FD93)
        for j in range(n - 1):
            has = per[few] > j
            acc[has] += h[first[has] + j] * U64(_LANES[j + 8])
        g, grow = np.concatenate([g, mix(acc)]), np.concatenate([grow, few])
        order = np.argsort(grow, kind="stable")
        g, grow = g[order], grow[order]
    bounds = np.searchsorted(grow, np.arange(rows + 1))
    for a, b in zip(bounds[:-1], bounds[1:], strict=True):
        g[a:b].sort()
    keep = np.ones(len(g), dtype=bool)
    keep[1:] = (g[1:] != g[:-1]) | (grow[1:] != grow[:-1])
    return g[keep], np.concatenate([[0], np.cumsum(np.bincount(grow[keep], minlength=rows))])


def set_keys(sets: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Order-free 64-bit key of each set (0 for an empty one)."""
    cs = np.zeros(len(sets) + 1, dtype=U64)
    np.cumsum(mix(sets ^ U64(0xA0761D6478BD642F)), out=cs[1:])
    total = cs[bounds[1:]] - cs[bounds[:-1]]
    return np.where(np.diff(bounds) > 0, mix(total + np.diff(bounds).astype(U64)), U64(0))
