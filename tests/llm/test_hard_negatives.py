"""Hard negatives against brute force, over several groups, blocks of anchors, hot vectors and windows."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from meadowlark.llm import hard_negatives as hn

SCHEMA = "vec_id long, embedding array<float>, label int"


def made(n, dims=9, seed=0, hot=0):
    """Three loose clusters; a part of the rows share one vector."""
    rng = np.random.default_rng(seed)
    mids = rng.normal(size=(3, dims))
    rows = []
    for i in range(n):
        v = mids[0] if i < hot else mids[i % 3] + rng.normal(size=dims) * 0.4
        rows.append((i * 5, [float(x) for x in v.astype(np.float32)], int(rng.integers(4))))
    random.Random(seed).shuffle(rows)
    return rows


def brute(rows, positives=5, negatives=10, low=30, high=90):
    kept = {}
    for i, v, label in rows:
        if i is None or v is None or label is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        x = [math.floor(256 * float(np.float32(c))) for c in v]
        label = (label + 1) % 10 if i % 7 == 0 else label
        kept[i] = min(kept.get(i, (label, x)), (label, x))
    out = set()
    for a, (own, x) in kept.items():
        if a % 100:
            continue
        scored = sorted((-sum(p * q for p, q in zip(x, y)), i, label) for i, (label, y) in kept.items() if i != a)
        for s, p, _ in [t for t in scored if t[2] == own][:positives]:
            inside = [t for t in scored if t[2] != own and 30 * -s <= 100 * -t[0] <= 90 * -s]
            out |= {(a, p, r, i, -s, -t) for r, (t, i, _) in enumerate(inside[:negatives], 1)}
    return out


def mined(spark, rows, **options):
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    ready = hn.prepared(df, relabel=lambda label, i: F.when(i % 7 == 0, (label + 1) % 10).otherwise(label))
    got = [tuple(r) for r in hn.mine(ready, F.col("vec_id") % 100 == 0, **options).collect()]
    assert len(got) == len(set(got))
    return set(got)


@pytest.mark.parametrize("options", [{}, {"group": 100, "block": 7, "words": 5, "sample": 50}, {"group": 1, "words": 1}])
def test_equals_brute_force(spark, options):
    rows = made(200 if options.get("group") == 1 else 900, hot=60 if options.get("group") == 1 else 320)
    want = brute(rows)
    assert len(want) > 100 and mined(spark, rows, **options) == want


def test_odd_rows(spark):
    rows = made(120, seed=4)
    rows += [(100, None, 1), (700, [1.0] * 9, None), (None, [1.0] * 9, 1), (800, [float("nan")] * 9, 1), (801, [float("inf")] + [0.0] * 8, 1), (802, [None] + [0.0] * 8, 1)]
    rows += [(900, [0.5, 0.25], 2), (1000, [], 2), (1100, [0.0] * 9, 3), (1200, [0.1] * 14, 9), rows[0], rows[0], (rows[1][0], [0.0] * 9, 0)]
    assert mined(spark, rows, group=40) == brute(rows)
    assert mined(spark, [(100, [1.0, 0.0], 1), (5, [1.0, 0.0], 2)]) == set()  # an anchor without a positive
    assert mined(spark, rows[:0]) == set()
    with pytest.raises(ValueError):
        mined(spark, [(100, [1e6] * 100, 1)])


def test_certified_visits_pass_over_cells():
    """Where clusters lie apart, the heap stops before most cells, and what it finds is right."""
    rng = np.random.default_rng(2)
    x = np.floor(np.concatenate([rng.normal(c * 400, 6, size=(300, 8)) for c in range(1, 9)]))
    books = hn.codebook(x[:, :4], 8), hn.codebook(x[:, 4:], 8)
    group = hn.Group(np.arange(len(x)), np.zeros(len(x), np.int64), x, books)
    seen = []
    one = hn.Search(-1, 0, x[-1], 4, [(-(1 << 62), 1 << 62)], 5, True)
    plain = one.score
    one.score = lambda g, spans: (seen.extend(spans), plain(g, spans))
    one.look(group)
    scores = (x @ x[-1]).astype(int)
    order = np.lexsort((np.arange(len(x)), -scores))[:5]
    at = {int(i): k for k, i in enumerate(group.ids)}
    assert sorted(one.best[0][1].tolist()) == sorted(order.tolist()) and len(at) == len(x)
    assert sum(b - a for a, b in seen) <= len(x) / 2
    bounds = [v[0] for v in group.visits(x[3], (float(np.linalg.norm(x[3, :4])), float(np.linalg.norm(x[3, 4:]))))]
    assert bounds == sorted(bounds, reverse=True) and len(bounds) >= 8


def test_window_ends():
    for p in range(-30, 2000):
        low, high = hn.window_of(p)
        assert {n for n in range(-40, 2001) if 30 * p <= 100 * n <= 90 * p} == set(range(low, high + 1))
