"""Hard negatives against plain Python: small blocks, ties, repeats, odd rows; the index against whole products."""

import math
import random
from fractions import Fraction

import numpy as np
import pytest

from lakestrata.llm import hard_negatives as H

LONG = (1 << 63) - 1
SCHEMA = "vec_id long, embedding array<float>, label int, key string, v int, windows string"


def brute(rows, positives=5, negatives=5, every=100):
    """(id, vector, label) rows -> sorted result rows."""
    ok = [
        (n, i, [math.floor(256 * float(np.float32(x))) for x in v], lab)
        for n, (i, v, lab) in enumerate(rows)
        if i is not None and lab is not None and v and all(x is not None and math.isfinite(x) for x in v)
    ]
    out = []
    for n, i, q, lab in ok:
        if i % every:
            continue
        others = [(max(-LONG, min(LONG, sum(a * b for a, b in zip(q, w, strict=True)))), j, m, l2) for m, j, w, l2 in ok if m != n and len(w) == len(q)]
        others.sort(key=lambda r: (-r[0], r[1], r[2]))
        for s, j, _, _ in [r for r in others if r[3] == lab][:positives]:
            window = [r for r in others if r[3] != lab and Fraction(80 * s, 100) <= r[0] <= s]
            out += [(i, j, k + 1, r[1], s, r[0]) for k, r in enumerate(window[:negatives])]
    return sorted(out)


def _rows(seed=1, n=400, dims=8):
    r = random.Random(seed)
    rows = [(i, [r.gauss(0, 0.3) for _ in range(dims)], r.randrange(4) if r.random() < 0.6 else 0) for i in range(n)]
    rows += [(1000 + i, [0.5] * dims, i % 2) for i in range(60)]  # one very common vector, all ties
    rows += [(2000 + i, [r.choice([-0.25, 0.0, 0.25]) for _ in range(dims)], r.randrange(3)) for i in range(200)]
    return rows


def _frame(spark, rows):
    return spark.createDataFrame([(*r, "k", 1, "w") for r in rows], SCHEMA).repartition(3)


def _got(df, **how):
    return sorted(tuple(r) for r in H.hard_negatives(df, "id % 100 = 0", **how).collect())


@pytest.mark.parametrize("levels", [(1.0,), (0.1, 0.5, 1.0)])
def test_small_blocks(spark, monkeypatch, levels):
    monkeypatch.setattr(H, "SLICE", 2)
    rows = _rows()
    want = brute(rows)
    assert len(want) > 50
    assert _got(_frame(spark, rows), block_rows=48, anchor_rows=2, levels=levels) == want


def test_odd_rows(spark):
    r = random.Random(2)
    rows = _rows(seed=5, n=120, dims=4)
    rows += [(100, [0.1, 0.2, 0.3, 0.4], 0), (100, [0.4, 0.3, 0.2, 0.1], 1), (7, [0.1, 0.2, 0.3, 0.4], 1), (7, [0.1, 0.2, 0.3, 0.4], 1)]
    rows += [(None, [0.5] * 4, 0), (300, None, 0), (400, [0.5] * 4, None), (500, [], 0), (600, [0.1, None, 0.1, 0.1], 0)]
    rows += [(700, [float("nan"), 0.1, 0.1, 0.1], 0), (800, [float("inf"), 0.1, 0.1, 0.1], 0), (900, [0.0] * 4, 0)]
    rows += [(3100 + i, [r.random() for _ in range(6)], i % 2) for i in range(30)]  # another length
    rows += [(5000 + 100 * i, [1e12 * r.random(), 1.0, -1e12, 0.5], i % 2) for i in range(8)]  # products beyond a long
    rows += [(9000, [-0.5, -0.5, 0.0, 0.0], 3), (9001, [0.5, 0.5, 0.0, 0.0], 3)]  # negative positives
    assert _got(_frame(spark, rows), block_rows=64) == brute(rows)


def test_empty_and_no_anchor(spark):
    assert _got(_frame(spark, [])) == []
    assert _got(_frame(spark, [(1, [0.5], 0), (2, [0.5], 1)])) == []
    assert _got(_frame(spark, [(100, [0.5], 0)])) == []


def test_index_omits_dimensions_and_loses_nothing():
    r = np.random.default_rng(3)
    x = np.floor(256 * r.normal(0, 1, (500, 32)) * 0.7 ** np.arange(32) * r.random((500, 1)))
    q = np.floor(256 * r.normal(0, 1, (20, 32)) * 0.7 ** np.arange(32))
    true = q @ x.T
    for share in (0.999, 0.99, 0.9, 0.5):
        low = np.quantile(true, share, axis=1)
        index = H.Index(np.arange(500), np.arange(500), np.zeros(500, np.int64), x)
        at, scores = index.scores(q, low)
        got = {(a, int(p)): s for a in range(20) for p, s in zip(at, scores[a], strict=True) if s >= low[a]}
        assert got == {(a, p): true[a, p] for a in range(20) for p in range(500) if true[a, p] >= low[a]}
        assert share < 0.99 or len(at) < 400
