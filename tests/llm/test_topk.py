from __future__ import annotations

import math
import random

import pytest

from medoria.llm import topk


def brute(rows, k, is_query):
    def usable(v):
        return v is not None and all(x is not None and math.isfinite(x) for x in v)

    known = [(i, [math.floor(256.0 * x) for x in v]) for i, v in rows if usable(v)]
    out = []
    for i, q in dict.fromkeys((i, tuple(v)) for i, v in known if i is not None and is_query(i)):
        scored = [(-sum(a * b for a, b in zip(q, c)), math.inf if j is None else j) for j, c in known if j != i and len(c) == len(q)]
        out += [(i, r + 1, None if j == math.inf else j, -s) for r, (s, j) in enumerate(sorted(scored)[:k])]
    return sorted(out, key=str)


@pytest.mark.parametrize("kind", ["random", "ties", "clustered"])
@pytest.mark.parametrize("groups", [(2048, 32768), (3, 11)])
def test_equals_brute_force(spark, kind, groups):
    draw = random.Random(kind)
    centre = [draw.uniform(-1, 1) for _ in range(13)]
    rows = []
    for i in range(90):
        v = [draw.uniform(-1, 1) for _ in range(13)]
        if kind == "ties":
            v = [round(x) / 2 for x in v]
        if kind == "clustered":
            v = [c * (1 + i % 3) + x / 50 for c, x in zip(centre, v)]
        rows.append((i, v))
    rows += [(90, None), (91, [None] * 13), (92, [math.nan] * 13), (93, [math.inf] + [0.0] * 12), (95, rows[5][1]), (None, rows[5][1])]
    rows += [(100, [1.0, 2.0]), (101, [3.0, 4.0]), (102, []), (103, []), (5, rows[5][1])]
    df = spark.createDataFrame([(i, v, "x") for i, v in rows], "vec_id long, embedding array<double>, score string")
    vectors = topk.quantised(df)
    found = topk.top_k(vectors.where("id % 5 = 0"), vectors, 4, *groups)
    assert sorted((tuple(r) for r in found.collect()), key=str) == brute(rows, 4, lambda i: i % 5 == 0)


def test_large_numbers_are_exact(spark):
    big = float(1 << 22)
    rows = [(0, [big, 1 / 256]), (1, [big, 1 / 256]), (2, [big, 0.0]), (3, [-big, 5.0])]
    vectors = topk.quantised(spark.createDataFrame(rows, "vec_id long, embedding array<double>"))
    found = topk.top_k(vectors.where("id = 0"), vectors, 5).collect()
    assert [(r["vec_id"], r["score"]) for r in found] == [(1, 2**60 + 1), (2, 2**60), (3, -(2**60) + 1280)]


def test_no_rows(spark):
    vectors = topk.quantised(spark.createDataFrame([], "vec_id long, embedding array<float>"))
    assert topk.top_k(vectors, vectors).count() == 0
