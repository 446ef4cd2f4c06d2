"""Nearest vectors against every pair."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from faremill.llm import nearest

SHAPE = "vec_id long, embedding array<double>"


def plain(rows, k=20):
    fit = [(i, v) for i, v in rows if v and all(x is not None and np.isfinite(x) for x in v) and any(v)]
    out = []
    for a, (i, q) in enumerate(fit):
        if i is None or i % 20:
            continue
        scored = []
        for b, (j, c) in enumerate(fit):
            if a != b and len(c) == len(q):
                total = 0.0
                for x, y in zip(q, c):
                    total += x * y
                scored.append((-total, j is None, j or 0))
        for rank, (score, none, j) in enumerate(sorted(scored)[:k], 1):
            out.append((i, rank, None if none else j, -score))
    return sorted(out, key=str)


def _got(spark, rows, shape=SHAPE, **how):
    frame = spark.createDataFrame(rows, shape).withColumns({c: F.lit("clash") for c in ("row", "vector", "dims", "down", "across")})
    return sorted((tuple(r) for r in nearest.nearest(frame, **how).collect()), key=str)


def _rows(n, dims=12, seed=1):
    draw = np.random.default_rng(seed)
    around = draw.normal(size=(5, dims))
    made = around[draw.integers(0, 5, n)] + draw.normal(size=(n, dims)) * 0.05
    made *= 10.0 ** draw.integers(-2, 3, n)[:, None]  # lengths over four decades
    return [(i, v.tolist()) for i, v in enumerate(made)]


def test_odd_rows_and_ties(spark):
    rows = _rows(150)
    rows += [(160, [0.0] * 12), (180, None), (200, []), (220, [1.0] * 11 + [None]), (240, [float("nan")] + [1.0] * 11)]
    rows += [(260, [float("-inf")] * 12), (20, rows[20][1]), (20, rows[20][1]), (None, rows[20][1]), (300, [1.0, 2.0]), (2**60, [2.0, 1.0]), (2**60 + 1, rows[40][1])]
    rows += [(400 + i, [3.0] * 12) for i in range(30)]  # more ties than a result holds
    assert _got(spark, rows) == plain(rows)


@pytest.mark.parametrize("sizes", [{}, {"block": 100, "queries": 5}])
def test_tiles_give_what_all_pairs_give(spark, sizes, monkeypatch):
    rows = _rows(900, seed=2)
    assert _got(spark, rows, **sizes) == plain(rows)


def test_fewer_candidates_than_asked_for_and_none(spark):
    rows = _rows(4, 3)
    assert _got(spark, rows) == plain(rows) and len(_got(spark, rows)) == 3
    assert _got(spark, [(0, [1.0])]) == [] and _got(spark, []) == []


def test_few_pairs_are_scored_again():
    draw = np.random.default_rng(3)
    c = draw.normal(size=(6000, 64))
    c /= np.linalg.norm(c, axis=1)[:, None]
    scored = []
    original = nearest.exact
    try:
        nearest.exact = lambda a, b: scored.append(len(a)) or original(a, b)
        best = nearest.search_tile(c[:100], np.arange(100), c, np.arange(6000), np.arange(6000), 20)
    finally:
        nearest.exact = original
    truth = np.argsort(-(c[:100] @ c.T), axis=1, kind="stable")[:, 1:21]
    assert (best.candidate.reshape(100, 20) == truth).all()
    assert sum(scored) < 100 * 6000 * 0.05
