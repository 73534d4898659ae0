from __future__ import annotations

import math

import numpy as np
import pytest

from tidemark.llm import topk

KIND = "id long, vector array<float>, label string, cell long, side int, rank int"


def frame(spark, rows, kind=KIND):
    return spark.createDataFrame([(i, v, "x", 3, 4, 5) for i, v in rows], kind)


def brute(rows, queries, k):
    usable = [(i, [math.floor(1024 * float(np.float32(x))) for x in v]) for i, v in rows if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for q in queries:
        mine = min((v for i, v in usable if i == q), default=None)
        if mine is not None:
            score = lambda v: max(-(2**63), min(2**63 - 1, sum(a * b for a, b in zip(mine, v, strict=True))))  # noqa: B023, E731
            found = sorted((-score(v), i) for i, v in usable if i != q and len(v) == len(mine))[:k]
            out += [(q, r + 1, i, -s) for r, (s, i) in enumerate(found)]
    return sorted(out)


def check(spark, rows, k=10):
    df = frame(spark, rows)
    got = sorted(tuple(r) for r in topk.search(df, df.where("id % 100 = 0"), k).collect())
    assert got == brute(rows, sorted({i for i, _ in rows if i is not None and i % 100 == 0}), k)


def test_against_brute_force(spark):
    rng = np.random.default_rng(0)
    check(spark, [(i, [float(x) for x in rng.normal(size=8)]) for i in range(400)])


def test_ties_repeats_nulls_and_lengths(spark):
    rows = [(i, [1.0, 0.5]) for i in range(0, 300)] + [(300, None), (301, [None, 1.0]), (302, [float("nan"), 1.0]), (303, [float("inf"), 1.0]), (400, [1.0]), (401, [2.0]), (200, [1.0, 0.5]), (150, [9.0, 9.0]), (150, [9.0, 9.0]), (None, [1.0, 1.0]), (500, [])]
    check(spark, rows)


def test_fewer_than_k(spark):
    check(spark, [(0, [1.0]), (1, [2.0]), (2, [-3.0])], 5)


def test_big_numbers_stay_exact(spark):
    check(spark, [(0, [3e7, 1.0]), (1, [3e7, 1.0]), (2, [3e7, 1.0009765625]), (3, [2e9, 5.0]), (4, [-1e20, 1.0])], 3)


def test_empty(spark):
    df = frame(spark, [(1, [1.0])])
    assert topk.search(df, df.where("false")).count() == 0 and topk.search(df.where("false"), df).count() == 0


def test_many_cells(spark, monkeypatch):
    rng = np.random.default_rng(1)
    rows = [(i, [float(x) for x in rng.integers(-2, 3, 4)]) for i in range(700)]
    monkeypatch.setattr(topk, "CELL_BYTES", 400)  # a grid of many rows and columns, and several levels of the tree
    check(spark, rows)


@pytest.mark.parametrize("n", [3, 11, 2048])
def test_partial_selection(n):
    rng = np.random.default_rng(n)
    q, v = rng.integers(-3, 4, (5, 3)).astype(float), rng.integers(-3, 4, (n, 3)).astype(float)
    ids = np.arange(n)
    score, found = topk._best(q, np.array([-1, 0, 1, 2, -2]), v, ids, 10)
    for i, me in enumerate([-1, 0, 1, 2, -2]):
        want = sorted((-float(q[i] @ v[j]), j) for j in range(n) if j != me)[:10]
        got = sorted((-s, j) for s, j in zip(score[i], found[i], strict=True) if s > -np.inf)[:10]
        assert got == want
