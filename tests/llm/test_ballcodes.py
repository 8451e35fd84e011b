from __future__ import annotations

import hashlib
import math
import random

import numpy as np
import pytest

from medoria.llm import ballcodes


def brute(rows, entries, parts=4, rounds=4):
    """Plain k-means in whole numbers, by the letter of the contract."""
    kept = []
    for i, v, label in rows:
        if v is not None and all(x is not None and math.isfinite(x) for x in v):
            kept.append((i, [math.floor(1024 * x) for x in v], label))
    kept.sort(key=lambda r: (r[0] is None, r[0], r[1]))
    if not kept:
        return [], ""
    length = len(kept[0][1])
    size = length // parts
    cut = lambda v: [tuple(v[p * size : (p + 1) * size]) for p in range(parts)]
    first = [v for _, v, _ in kept[:entries] if len(v) == length]
    books = [[cut(v)[p] for v in first] for p in range(parts)]

    def nearest(x, book):
        return min((sum((a - b) ** 2 for a, b in zip(x, c)), e) for e, c in enumerate(book))

    usable = [(i, cut(v), label) for i, v, label in kept if len(v) == length]
    for _ in range(rounds):
        members = [[[] for _ in book] for book in books]
        for _, v, _ in usable:
            for p, x in enumerate(v):
                members[p][nearest(x, books[p])[1]].append(x)
        books = [
            [tuple(sum(c) // len(m) for c in zip(*m)) if m else old for m, old in zip(ms, book)]
            for ms, book in zip(members, books)
        ]
    out = []
    for i, v, label in usable:
        found = [nearest(x, books[p]) for p, x in enumerate(v)]
        out.append((i, label, "".join(f"{e:02x}" for _, e in found), sum(d for d, _ in found)))
    total = {}
    for _, label, _, error in out:
        total[label] = total.get(label, 0) + error
    text = ",".join(str(x) for book in books for c in book for x in c)
    digest = hashlib.sha256(text.encode()).hexdigest()
    other = [(i, None, None, total.get(label)) for i, v, label in kept if len(v) != length]
    return sorted([(i, code, error, total[label]) for i, label, code, error in out] + other, key=str), digest


def run(df, entries):
    found = ballcodes.codes(df, entries=entries).collect()
    rows = sorted(((r["vec_id"], r["code"], r["error"], r["label_error"]) for r in found), key=str)
    return rows, {r["codebooks_sha256"] for r in found}


@pytest.mark.parametrize("kind", ["random", "ties", "clustered", "large"])
@pytest.mark.parametrize("entries", [1, 7, 40])
def test_equals_plain_k_means(spark, kind, entries):
    draw = random.Random(kind)
    centres = [[draw.uniform(-1, 1) for _ in range(12)] for _ in range(9)]
    rows = []
    for i in range(300):
        v = [draw.uniform(-1, 1) for _ in range(12)]
        if kind == "ties":
            v = [round(2 * x) / 2 for x in v]
        if kind == "clustered":
            v = [c + x / 100 for c, x in zip(draw.choice(centres), v)]
        if kind == "large":
            v = [x * 2.0**15.5 for x in v]
        rows.append((i, v, draw.choice((None, 1, 2))))
    rows += [(3, rows[3][1], 1), (None, rows[5][1], None), (900, None, 1), (901, [None] * 12, 2), (902, [math.nan] * 12, 2)]
    rows += [(903, [math.inf, *rows[0][1][1:]], 2), (904, [1.0, 2.0], 1), (905, [], None)]
    # columns whose names the operator uses itself
    columns = "vec_id long, embedding array<double>, label int, v string, code string, own int, of int, error string"
    df = spark.createDataFrame([(*r, "x", "x", 1, 1, "x") for r in rows], columns).repartition(3)
    expected, digest = brute(rows, entries)
    found, digests = run(df, entries)
    assert found == expected and digests == {digest}


def test_every_ring_gives_the_nearest_entry():
    draw = np.random.default_rng(1)
    for spread in (0, 1, 30, 1000):
        centres = draw.integers(-1000, 1000, (12, 5))
        x = centres[draw.integers(0, 12, 4000)] + draw.integers(-spread, spread + 1, (4000, 5))
        for n in (1, 2, 3, 200):
            entries = x[draw.integers(0, 4000, n)]
            expected = ballcodes.assign(x, entries, None)
            # whatever the entry before was
            for before in (expected[0], draw.integers(0, n, 4000)):
                code, d = ballcodes.assign(x, entries, before)
                assert (code == expected[0]).all() and (d == expected[1]).all()


def test_stable_cores_skip_work(monkeypatch):
    draw = np.random.default_rng(2)
    centres = np.arange(50)[:, None] * 10_000 * np.ones((1, 4), np.int64)
    before = draw.integers(0, 50, 5000)
    x = (centres[before] + draw.integers(-9, 9, (5000, 4))).astype(np.int64)
    monkeypatch.setattr(ballcodes, "_nearest", None)  # no row may be compared with all entries
    code, _ = ballcodes.assign(x, centres.astype(np.int64), before)
    assert (code == before).all()


def test_no_rows(spark):
    df = spark.createDataFrame([], "vec_id long, embedding array<float>, label int")
    assert ballcodes.codes(df).count() == 0
    assert ballcodes.codes(spark.createDataFrame([(1, None, 1)], df.schema)).count() == 0


def test_long_vectors(spark):
    draw = random.Random(3)
    rows = [(i, [draw.uniform(-1, 1) for _ in range(4000)], i % 2) for i in range(12)]
    found, digests = run(spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int"), 5)
    expected, digest = brute(rows, 5)
    assert found == expected and digests == {digest}
