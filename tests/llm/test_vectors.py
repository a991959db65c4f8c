"""Centroid clustering and hard negatives against brute force in Python's integers, at any magnitude."""

import hashlib
import math

import numpy as np
import pytest

from skein.llm import centroids, negatives

SCHEMA = "vec_id long, label int, embedding array<double>, cluster string, tile int, rank int"


def _table(spark, rows):
    return spark.createDataFrame([(*r, "x", 1, 2) for r in rows], SCHEMA).repartition(3)


def _floor(v):
    return [int(x) * 256 if abs(x) > 2**53 else math.floor(x * 256) for x in v]


def _random(n, width, seed, scale=1.0, labels=3):
    r = np.random.default_rng(seed)
    return [(i, int(r.integers(labels)), (r.normal(0, scale, width)).tolist()) for i in range(n)]


def _clusters(rows, k, rounds, width):
    kept = [(i, _floor(v)) for i, _, v in rows if v is not None and len(v) == width and all(x is not None and math.isfinite(x) for x in v)]
    name = lambda i: (1, "") if i is None else (0, hashlib.sha256(f"2:{i}".encode()).hexdigest())
    c = [v for _, v in sorted(kept, key=lambda r: (name(r[0]), r[1]))[:k]]
    far = lambda v, c: sum((a - b) ** 2 for a, b in zip(v, c))
    near = lambda v: min((far(v, x), j) for j, x in enumerate(c))
    for _ in range(rounds):
        own = [[] for _ in c]
        for _, v in kept:
            own[near(v)[1]].append(v)
        c = [[sum(x) // len(o) for x in zip(*o)] if o else old for o, old in zip(own, c)]
    most = 2**63 - 1
    out = [(i, near(v)[1], near(v)[0]) for i, v in kept]
    of = {j: min(most, sum(d for _, g, d in out if g == j)) for j in range(len(c))}
    return sorted(((i, j, min(most, d), of[j], min(most, sum(x for *_, x in out)), hashlib.sha256(",".join(map(str, c[j])).encode()).hexdigest()) for i, j, d in out), key=str)


ODD = [(1, 0, None), (2, 0, [1.0]), (3, 0, [math.nan, 1.0, 1.0, 1.0]), (4, 0, [math.inf, 1.0, 1.0, 1.0]), (5, 0, [None, 1.0, 1.0, 1.0]), (None, 0, [0.5, 0.25, 0.0, -3.0]), (6, 1, [0.0] * 4), (7, None, [1.0, 2.0, 3.0, 4.0]), (8, 1, [])]


@pytest.mark.parametrize("scale", [1.0, 1e5, 1e7, 1e9, 1e200, 1e307])
def test_clusters_match_brute_force(spark, scale, monkeypatch):
    monkeypatch.setattr(centroids, "BLOCK", 7)
    rows = _random(60, 4, 1, scale) + _random(5, 4, 2, scale) + ODD
    got = centroids.cluster(_table(spark, rows), clusters=5, rounds=3, width=4).collect()
    assert sorted((tuple(r) for r in got), key=str) == _clusters(rows, 5, 3, 4)


def test_few_vectors_ties_and_empty_tables(spark):
    rows = [(i, 0, [1.0, 1.0]) for i in (5, 5, 9, None, None)] + [(7, 0, [2.0, 1.0])]
    got = centroids.cluster(_table(spark, rows), clusters=40, rounds=5, width=2).collect()
    assert sorted((tuple(r) for r in got), key=str) == _clusters(rows, 40, 5, 2) and len(got) == 6
    assert centroids.cluster(_table(spark, rows), width=3).count() == 0
    assert centroids.cluster(_table(spark, rows).limit(0), width=2).count() == 0


def _negatives(rows, positives=5, most=3, low=50, high=95, every=5):
    cut = lambda n: max(-(2**63), min(2**63 - 1, n))
    kept = [(i, g, _floor(v)) for i, g, v in rows if g is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    order = lambda r: (-r[0], r[1] is None, r[1] or 0)
    out = []
    for a, (i, g, v) in enumerate(kept):
        if i is None or i % every:
            continue
        score = [(cut(sum(x * y for x, y in zip(v, w))), j, h) for b, (j, h, w) in enumerate(kept) if b != a and len(w) == len(v)]
        for p, j, _ in sorted((s for s in score if s[2] == g), key=order)[:positives]:
            found = sorted((s for s in score if s[2] != g and low * p <= 100 * s[0] <= high * p), key=order)[:most]
            out += [(i, j, k + 1, s[1], p, s[0]) for k, s in enumerate(found)]
    return sorted(out, key=str)


@pytest.mark.parametrize("scale", [0.05, 1.0, 3e5, 3e6, 1e9, 1e200])
def test_negatives_match_brute_force(spark, scale, monkeypatch):
    monkeypatch.setattr(negatives, "TILE", 16)
    monkeypatch.setattr(negatives, "ANCHORS", 3)
    monkeypatch.setattr(negatives, "GROUP", 8)
    monkeypatch.setattr(negatives, "COLUMN", 4000)
    mean = np.random.default_rng(9).normal(0, 2 * scale, 10)
    rows = [(i, g, (np.array(v) + mean).tolist()) for i, g, v in _random(150, 10, 3, scale)]
    rows += rows[:12] + [(i, 1 - g % 2, v) for i, g, v in rows[20:30]] + _random(40, 3, 4, scale) + ODD
    got = negatives.mine(_table(spark, rows), anchor=_every(5)).collect()
    want = _negatives(rows)
    assert sorted((tuple(r) for r in got), key=str) == want and (len(want) > 100 or scale >= 1e9)  # beyond, all scores are the greatest long


def _every(n):
    from pyspark.sql import functions as F

    return F.col("vec_id") % n == 0


def test_many_equal_vectors_and_few_positives(spark):
    rows = [(i, i % 2, [1.0, 0.0]) for i in range(300)] + [(300 + i, i % 2, [0.8, 0.1 * i]) for i in range(40)] + [(350, 7, [1.0, 1.0])]
    got = negatives.mine(_table(spark, rows), positives=2, negatives=4).collect()
    assert sorted((tuple(r) for r in got), key=str) == _negatives(rows, 2, 4, every=50)
    assert negatives.mine(_table(spark, rows).limit(0)).count() == 0
    assert negatives.mine(_table(spark, rows).where("vec_id % 50 <> 0")).count() == 0


def test_bounds_hold(spark):
    books = negatives.fit(negatives.usable(_table(spark, _random(200, 10, 5)), "embedding", _label()))
    row = negatives._pack(0, 10, np.arange(50), np.zeros(50, bool), np.zeros(50, np.int64), np.random.default_rng(6).normal(0, 3, (50, 10)), books, negatives.SPAN)
    c = negatives.Tile(row)
    low, high = negatives.Bounds(c.vectors, books, negatives.SPAN).of(c)
    exact = c.vectors @ c.vectors.T
    assert (low <= exact).all() and (exact <= high).all() and np.median(high - low) < np.abs(exact).max()


def _label():
    from pyspark.sql import functions as F

    return F.col("label")
