"""Anchors of fixed-length windows (numpy kernel of operator 10).

Every window of ``length`` bytes chooses one anchor: the k-byte string inside
it with the least hash, the leftmost on a tie.  The choice depends on the
window's bytes alone, so equal windows anywhere choose equal anchors at equal
places.  Neighbouring windows that share an anchor form a context, the bytes
from the first such window's start to the last one's end.
"""

from __future__ import annotations

import numpy as np

from . import kernels as K

U64 = np.uint64
_PLACE = U64((1 << 31) - 1)


def _sliding_min(x: np.ndarray, w: int) -> np.ndarray:
    """Minimum of every w neighbours."""
    step, have = x, 1
    while have * 2 <= w:
        step = np.minimum(step[: len(step) - have], step[have:])
        have *= 2
    if have < w:
        n = len(x) - w + 1
        step = np.minimum(step[:n], step[w - have : w - have + n])
    return step


def contexts(data: np.ndarray, off: np.ndarray, length: int, k: int):
    """Contexts of all rows: (row, first window start, last window start, anchor hash, context hash).

    Starts are places in ``data``."""
    none = np.zeros(0, np.int64)
    n = len(data)
    if n < length:
        return none, none, none, none.view(U64), none.view(U64)
    prefix = K.prefix_hash(data)
    back = K.powers(K._BASE_INV, n + 1)
    m = n - k + 1
    gram = K.mix((prefix[k:] - prefix[:m]) * back[:m])
    least = _sliding_min((gram & ~_PLACE) | np.arange(m, dtype=U64), length - k + 1)
    place = (least & _PLACE).astype(np.int64)
    # windows that do not cross rows
    start = np.flatnonzero(np.diff(off) >= length)
    if not len(start):
        return none, none, none, none.view(U64), none.view(U64)
    ok = np.zeros(len(place) + 1, dtype=np.int8)
    np.add.at(ok, off[start], 1)
    np.add.at(ok, off[start + 1] - length + 1, -1)
    inside = np.cumsum(ok[:-1]) > 0
    new = inside.copy()
    new[1:] &= ~inside[:-1] | (place[1:] != place[:-1])
    new[off[start]] = True
    first = np.flatnonzero(new)
    end = inside.copy()
    end[:-1] &= ~inside[1:] | new[1:]
    last = np.flatnonzero(end)
    row = np.searchsorted(off, first, "right") - 1
    return row, first, last, gram[place[first]], K.span_hash(prefix, first, last + length)
