from __future__ import annotations

import random

import numpy as np

from medoria.llm import quality


def rows(n, seed):
    draw = random.Random(seed)
    out = []
    for k in range(n):
        words = ["".join(draw.choice("abcdefgh") for _ in range(draw.randint(1, 9))) for _ in range(draw.randint(3, 90))]
        good = k % 3 > 0
        text = " ".join(words) + "." if good else " ".join(w.upper() + draw.choice(["!!", "$$$", " |"]) for w in words)
        out.append((k, text, int(good)))
    return out


def test_ranking_separates_held_out_rows(spark):
    learnt, asked = rows(300, 1), rows(120, 2)
    docs = spark.createDataFrame([(k, t, 0) for k, t, _ in learnt + [(0, "again", 1)]], "doc_id long, text string, score int")
    labels = spark.createDataFrame([(k, q) for k, _, q in learnt] + [(5, None), (None, 1)], "doc_id long, quality int")
    ranking = quality.fit(docs, labels)
    asked_docs = spark.createDataFrame([(k, t) for k, t, _ in asked], "doc_id long, text string")
    found = {r["doc_id"]: r["score"] for r in quality.score(asked_docs, ranking).collect()}
    right = sum((found[k] >= quality.THRESHOLD) == (q == 1) for k, _, q in asked)
    assert right >= 0.97 * len(asked)


def test_weights_follow_the_pairs():
    draw = np.random.default_rng(0)
    x = draw.normal(size=(400, quality.N_FEATURES))
    label = (x[:, 3] - x[:, 7] > 0).astype(int)
    ranking = quality.rank(x, label)
    score = ranking.score(x)
    assert ((score >= quality.THRESHOLD) == (label == 1)).mean() > 0.97
    assert ranking.weights[3] > 1 and ranking.weights[7] < -1


def test_awkward_rows(spark):
    docs = spark.createDataFrame([(1, None), (2, ""), (None, " \n"), (4, "ä" * 10_000), (4, "ä" * 10_000)], "doc_id long, text string")
    none = spark.createDataFrame([], "doc_id long, quality int")
    for labels, expected in ((none, 0.5), (spark.createDataFrame([(1, 1)], none.schema), 1.0)):
        found = quality.score(docs, quality.fit(docs, labels)).collect()
        assert [r["score"] for r in found] == [expected] * 5
    both = spark.createDataFrame([(1, 0), (4, 1)], none.schema)
    found = quality.score(docs, quality.fit(docs, both)).collect()
    assert all(0 <= r["score"] <= 1 for r in found) and found[0]["score"] == found[1]["score"]
    assert quality.score(docs.limit(0), quality.fit(docs, none)).count() == 0


def test_the_loss_is_at_its_least():
    """The weights against the loss itself, summed pair by pair: no step along a weight lowers it."""
    draw = np.random.default_rng(3)
    x = draw.normal(size=(120, quality.N_FEATURES))
    label = (x[:, 0] + draw.normal(size=120) > 0.4).astype(int)
    ranking = quality.rank(x, label)
    z = (x - x.mean(axis=0)) / (x.std(axis=0) + 1e-9)
    z = np.concatenate([np.clip(z, -6, 6), np.clip(z, -6, 6) ** 2], axis=1)
    pairs = quality.pairs_of(np.flatnonzero(label == 1), np.flatnonzero(label == 0)).T

    def loss(w):
        total = 0.0
        for won, lost in pairs:
            total += np.log1p(np.exp(-(w @ z[won] - w @ z[lost])))
        return total / len(pairs) + quality.RIDGE / 2 * w @ w

    least = loss(ranking.weights)
    for k in range(len(ranking.weights)):
        for step in (-1e-2, 1e-2):
            moved = ranking.weights.copy()
            moved[k] += step
            assert loss(moved) > least


def test_the_cut_is_a_quantile():
    draw = np.random.default_rng(4)
    x = draw.normal(size=(200, quality.N_FEATURES))
    label = (x[:, 1] + draw.normal(size=200) > 0.5).astype(int)
    for quantile in (None, 0.0, 0.25, 0.9, 1.0):
        passed = (quality.rank(x, label, quantile).score(x) >= quality.THRESHOLD).sum()
        assert passed == (label.sum() if quantile is None else round(200 * (1 - quantile)))


def test_very_long_texts(spark):
    long = "word and " * 300_000
    docs = spark.createDataFrame([(1, long), (2, long), (3, long[:900])], "doc_id long, text string")
    labels = spark.createDataFrame([(3, 1), (1, 0)], "doc_id long, quality int")
    found = {r["doc_id"]: r["score"] for r in quality.score(docs, quality.fit(docs, labels)).collect()}
    assert found[1] == found[2] and all(0 <= s <= 1 for s in found.values())


def _fitted(monkeypatch, spark, block_rows, texts):
    """The ranking, and the rows of all blocks with what is counted of them."""
    monkeypatch.setattr(quality, "BLOCK_ROWS", block_rows)
    seen, make = [], quality._blocks
    monkeypatch.setattr(quality, "_blocks", lambda *a: seen.append(make(*a)) or seen[0])
    docs = spark.createDataFrame([(k, t) for k, t, _ in texts], "doc_id long, text string")
    labels = spark.createDataFrame([(k, q) for k, _, q in texts], "doc_id long, quality int")
    ranking = quality.fit(docs, labels)
    blocks = seen[0].collect()
    return ranking, [
        (np.frombuffer(b["x"]).reshape(-1, quality.N_FEATURES), np.frombuffer(b["label"], np.int8), np.frombuffer(b["own"], bool))
        for b in blocks
    ]


def test_every_label_is_fitted(spark, monkeypatch):
    """Many more labels than a block takes: all are in the model, and the cut is a quantile of all."""
    texts = rows(900, 5)
    ranking, blocks = _fitted(monkeypatch, spark, 64, texts)
    every = np.array([quality.features(t.encode()) for _, t, _ in texts])
    label = np.array([q for _, _, q in texts])
    assert len(blocks) == 15 and sum(own.sum() for _, _, own in blocks) == 900
    assert np.allclose(ranking.mean, every.mean(axis=0)) and np.allclose(ranking.scale, every.std(axis=0) + 1e-9)
    assert (ranking.strength(every) < ranking.cut).sum() == (label == 0).sum()
    # the gradient of the loss over the pairs of all blocks is nothing
    slope, n = -quality.RIDGE * ranking.weights, sum(quality.PAIRS_EACH * len(x) for x, _, _ in blocks)
    for x, kind, _ in blocks:
        z = quality._curved((x - ranking.mean) / ranking.scale)
        won, lost = quality.pairs_of(np.flatnonzero(kind == 1), np.flatnonzero(kind == 0))
        gap = z[won] - z[lost]
        slope = slope + gap.T @ (1 / (1 + np.exp(gap @ ranking.weights))) / n
    assert np.abs(slope).max() < 1e-6


def test_a_rare_label_is_in_every_block(spark, monkeypatch):
    texts = [(k, t, int(k not in (7, 400, 511))) for k, t, _ in rows(600, 6)]
    ranking, blocks = _fitted(monkeypatch, spark, 50, texts)
    assert len(blocks) == 12 and all(0 < (label == 0).sum() < len(label) for _, label, _ in blocks)
    assert sum(own.sum() for _, _, own in blocks) == 600
    every = np.array([quality.features(t.encode()) for _, t, _ in texts])
    assert (ranking.score(every) < quality.THRESHOLD).sum() == 3


def test_the_cut_among_ties():
    each = lambda step: [step(np.array(p, float), None, np.ones(len(p), bool)) for p in ([1, 1, -2.5], [1, 0, 3], [])]
    ordered = [-2.5, 0, 1, 1, 1, 3]
    assert [quality._smallest(each, lambda x: x, k) for k in range(6)] == ordered
    cuts = [quality._cut(each, lambda x: x, 6, k / 6) for k in range(7)]
    assert cuts == [-3.5, -1.25, 0.5, 1, 1, 2, 4]
