from __future__ import annotations

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from medoria.llm import neighbours


def brute(rows, k, is_query):
    known = {}
    for i, v in rows:
        if v is not None and all(x is not None and math.isfinite(x) for x in v) and any(v):
            known[i, tuple(v)] = None
    out = {}
    for i, q in known:
        if i is not None and is_query(i):
            scored = [(-float(np.dot(q, c)), math.inf if j is None else j) for j, c in known if (j, c) != (i, q) and len(c) == len(q)]
            out.setdefault(i, []).extend((r + 1, None if j == math.inf else j, -s) for r, (s, j) in enumerate(sorted(scored)[:k]))
    return out


def collected(df):
    out = {}
    for r in sorted(df.collect(), key=lambda r: (r["query_id"], r["rank"])):
        out.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
    return out


def some_vectors(kind, n, length, draw):
    centres = [[draw.gauss(0, 1) for _ in range(length)] for _ in range(12)]
    for i in range(n):
        v = [draw.gauss(0, 1) for _ in range(length)]
        if kind == "clustered":
            v = [c + x / 20 for c, x in zip(draw.choice(centres), v)]
        if kind == "ties":
            v = [float(round(x)) for x in v]
        if kind == "norms":
            v = [x * 10 ** draw.uniform(-3, 3) for x in v]
        yield i, v


@pytest.mark.parametrize("kind", ["random", "clustered", "ties", "norms"])
def test_one_cell_is_exact(spark, kind):
    rows = [*some_vectors(kind, 150, 9, random.Random(kind))]
    rows += [(200, None), (201, [0.0] * 9), (202, [math.nan] * 9), (203, [math.inf] + [0.0] * 8), (204, [None] * 9), (205, [])]
    rows += [(206, rows[5][1]), (5, rows[5][1]), (None, rows[7][1]), (210, [1.0, 2.0]), (211, [3.0, 4.0]), (212, [-0.0, 1.0]), (213, [0.0, 1.0])]
    df = spark.createDataFrame([(*r, 1.0, "x") for r in rows], "vec_id long, embedding array<double>, score double, name string")
    for block in (16_384, 7):
        found = collected(neighbours.search(df.repartition(3), F.col("vec_id") % 5 == 0, k=6, block=block))
        expected = brute(rows, 6, lambda i: i % 5 == 0)
        assert found.keys() == expected.keys()
        for i, best in expected.items():
            assert [x[:2] for x in found[i]] == [x[:2] for x in best]
            assert np.allclose([x[2] for x in found[i]], [x[2] for x in best], rtol=1e-12)


@pytest.mark.parametrize("kind", ["random", "clustered", "norms"])
def test_recall_of_many_cells(spark, monkeypatch, kind):
    monkeypatch.setattr(neighbours, "OCCUPANCY", 60)
    rows = [*some_vectors(kind, 3000, 16, random.Random(kind))]
    rows += [(3000 + k, rows[0][1]) for k in range(1000)]  # copies of one vector
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(3)
    found = collected(neighbours.search(df, F.col("vec_id") % 20 == 0, k=10, block=500))
    expected = brute(rows, 10, lambda i: i % 20 == 0)
    assert found.keys() == expected.keys()
    hits = sum(len({x[1] for x in found[i]} & {x[1] for x in best}) for i, best in expected.items())
    assert hits >= 0.9 * sum(map(len, expected.values()))
    # scores are those of the vectors, ranks follow them
    vectors = dict(rows)
    for i, best in found.items():
        assert [r for r, _, _ in best] == [*range(1, 11)]
        assert best == sorted(best, key=lambda x: (-x[2], x[1]))
        assert all(j != i and math.isclose(s, float(np.dot(vectors[i], vectors[j])), rel_tol=1e-9, abs_tol=1e-9) for _, j, s in best)


def test_cells_within_reach_are_all_there_are():
    draw = np.random.default_rng(1)
    places = draw.normal(size=(40, 3)) * 2
    others = draw.normal(size=(4000, 3)) * 2
    row, cell, far = neighbours.cells_within(places, 3, 1.7)
    assert (np.diff(far) >= 0).all()
    visited = set(zip(row.tolist(), cell.tolist()))
    names = neighbours.cells_of(others, 3)
    low = np.floor(others)
    for i, p in enumerate(places):
        gap = np.maximum(np.maximum(low - p, p - low - 1), 0)
        near = (gap**2).sum(axis=1) <= 1.7
        assert all(((i, int(names[j])) in visited) == near[j] for j in range(len(others)))


def test_no_rows(spark):
    df = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert neighbours.search(df, F.col("vec_id") % 20 == 0).count() == 0
    one = spark.createDataFrame([(0, [1.0])], df.schema)
    assert neighbours.search(one, F.col("vec_id") % 20 == 0).count() == 0
