"""Hard negatives against all scores, tree bounds, ties, hot labels and awkward rows."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from wayfold.llm import negatives

SCHEMA = "vec_id long, embedding array<float>, label int, EMBEDDING string, uid int"


def brute(rows, low=80, high=100, scale=256.0, every=100, k=5):
    ok = [(i, [int(np.floor(scale * float(np.float32(x)))) for x in v], lab) for i, v, lab in rows if i is not None and lab is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)]
    dot = lambda a, b: max(-(2**63), min(2**63 - 1, sum(x * y for x, y in zip(a, b, strict=False))))
    out = []
    for n, (i, v, lab) in enumerate(ok):
        if i % every:
            continue
        scored = [(-dot(v, w), j, other) for m, (j, w, other) in enumerate(ok) if m != n]
        for s, j, _ in sorted(x for x in scored if x[2] == lab)[:k]:
            fits = sorted(x[:2] for x in scored if x[2] != lab and low * -s <= 100 * -x[0] <= high * -s)[:k]
            out += [(i, j, r, m, -s, -t) for r, (t, m) in enumerate(fits, 1)]
    return sorted(out)


def got(spark, rows, **more):
    df = spark.createDataFrame([(*r, "z", 1) for r in rows], SCHEMA).repartition(3)
    return sorted(map(tuple, negatives.hard_negatives(df, F.col("vec_id") % 100 == 0, **more).collect()))


def made(seed, n, dim=8, labels=3):
    r = np.random.default_rng(seed)
    centre = r.normal(size=(labels, dim))
    lab = np.where(r.random(n) < 0.4, 0, r.integers(0, labels, n))  # a hot label
    v = (centre[lab] * 0.7 + r.normal(size=(n, dim)) * 0.5).astype(np.float32)
    return [(int(i * 5), v[i].tolist(), int(lab[i])) for i in range(n)]


@pytest.mark.parametrize("tree,leaf", [(2048, 64), (50, 4)])
def test_equals_all_scores(spark, monkeypatch, tree, leaf):
    rows = made(3, 1000)
    monkeypatch.setattr(negatives, "TREE", tree)
    monkeypatch.setattr(negatives, "LEAF", leaf)
    want = brute(rows)
    assert len(want) > 50 and got(spark, rows) == want


def test_many_groups(spark, monkeypatch):
    rows = made(4, 500)
    for name, v in (("TREE", 16), ("LEAF", 4), ("GROUP_BYTES", 2000), ("ANCHOR_BYTES", 300)):
        monkeypatch.setattr(negatives, name, v)
    assert got(spark, rows) == brute(rows)


def test_ties_and_repeated_rows(spark):
    r = random.Random(1)
    rows = [(i, [r.choice([0.5, 1.0]), r.choice([0.5, 1.0])], r.randrange(2)) for i in range(0, 900, 3)]
    rows += [(0, [1.0, 1.0], 0), (0, [1.0, 1.0], 0), (300, [0.5, 0.5], 1), (7, [1.0, 1.0], 0), (7, [1.0, 1.0], 1)]
    assert got(spark, rows) == brute(rows)


def test_awkward_rows(spark):
    rows = [(None, [1.0, 2.0], 1), (0, None, 1), (100, [1.0, None], 1), (200, [float("nan"), 1.0], 1), (300, [float("inf"), 1.0], 1), (400, [1.0, 1.0], None), (500, [], 1), (600, [1.0], 1), (700, [1.0, 2.0, 3.0], 2), (1, [1.0, 1.0], 1), (2, [0.9], 2), (3, [], 2), (-100, [-1.0, 1.0], 1), (800, [0.0, 0.0], 1)]
    assert got(spark, rows) == brute(rows)
    assert got(spark, []) == [] and got(spark, [(100, [1.0], 1)]) == [] and got(spark, [(101, [1.0], 1), (102, [1.0], 2)]) == []
    large = [(100 * i, [3e9 * (i + 1), -2e9], i % 2) for i in range(6)]
    assert got(spark, large) == brute(large)


def test_window_bounds():
    assert negatives.bounds_of(10, 80, 100) == (8, 10) and negatives.bounds_of(7, 80, 100) == (6, 7)
    low, high = negatives.bounds_of(-10, 80, 100)
    assert low > high and negatives.bounds_of(0, 80, 100) == (0, 0)


def test_trees_bound_and_prune():
    r = np.random.default_rng(5)
    centre = r.normal(size=(8, 16)) * 100
    v = np.floor(centre[r.integers(0, 8, 2000)] + r.normal(size=(2000, 16)))
    order, c, radius = negatives.grown(v)
    row = {"n": 2000, "width": 16, "uid": 0, "label": 1, "ids": np.arange(2000).tobytes(), "vectors": v[order].tobytes(), "centres": c.tobytes(), "radii": radius.tobytes()}
    t = negatives.Tree(row, 16)
    q = np.floor(r.normal(size=(50, 16)) * 100)
    norm = np.sqrt((q**2).sum(axis=1))
    assert sorted(order.tolist()) == list(range(2000))
    for i, (a, e) in enumerate(t.spans):
        low, high = t.bounds(i, q, norm)
        s = q @ t.v[a:e].T
        assert (s >= low[:, None]).all() and (s <= high[:, None]).all()
    anchors = negatives.Anchors([{"uid": -1 - i, "label": 1, "vectors": x.tobytes()} for i, x in enumerate(q)], 16)
    best = negatives.Best(50, 5)
    assert negatives.best_of(anchors, t, best) < 0.4 * 50 * 2000  # most leaves are never read
    assert (best.score == -np.sort(-(q @ v.T), axis=1)[:, :5]).all()
