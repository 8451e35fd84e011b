from __future__ import annotations

import random

import numpy as np
import pytest

import corpus_pipeline
from medoria.llm import similar_sets
from tests.llm.test_simhash import groups
from tests.llm.test_stages import documents, edited, shingles


def similar(x, y):
    return not (x or y) or 5 * len(x & y) >= 4 * len(x | y)


def check(spark, texts, monkeypatch=None, **bounds):
    docs = spark.createDataFrame([(k, t, 1, "x") for k, t in enumerate(texts)], "doc_id long, text string, node int, point string")
    found = similar_sets.similar_groups(docs.repartition(5), **bounds).collect()
    sets = {k: shingles(t or "") for k, t in enumerate(texts)}
    expected = groups(list(sets), sets, similar)
    assert {r["doc_id"]: r["component_id"] for r in found} == expected
    return len(set(expected.values()))


def links_of(spark, texts, monkeypatch):
    """The rows that the tasks hand on."""
    seen = []
    inner = similar_sets.components
    monkeypatch.setattr(similar_sets, "components", lambda edges: (seen.append(edges.count()), inner(edges))[1])
    docs = spark.createDataFrame([*enumerate(texts)], "doc_id long, text string")
    n = similar_sets.similar_groups(docs).select("component_id").distinct().count()
    return seen, n


@pytest.mark.parametrize("bounds", [{}, {"tile_shingles": 300, "tile_rows": 5}])
def test_sets_of_all_sizes(spark, bounds):
    draw = random.Random(21)
    texts = [None, "", " ", "one", "ONE", "one two three four five", "a " * 400]
    for n in (5, 6, 7, 8, 9, 10, 12, 13, 16, 20, 40, 90, 300, 2500):
        base = [f"w{draw.randint(0, 10**6)}" for _ in range(n)]
        for _ in range(7):
            new = edited(draw, base, draw.randint(0, 1 + n // 40))
            texts.append(" ".join(new[draw.choice((0, 0, 1)) :] + [f"y{draw.randint(0, 9)}"] * draw.choice((0, 0, 1, 1 + n // 10))))
    assert check(spark, texts, **bounds) < len(texts) - 20


def test_short_sets_of_few_words(spark):
    """Empty parts, and shingles that many texts share."""
    draw = random.Random(22)
    texts = []
    for _ in range(260):
        words = ["a"] * draw.randint(4, 9) + [draw.choice("ab") for _ in range(draw.randint(0, 14))]
        texts.append(" ".join(words))
    check(spark, texts, tile_rows=40)


def test_keys_are_shared_by_all_similar_sets():
    draw = np.random.default_rng(23)
    bands = similar_sets.Bands((4, 5))
    for n in [*range(4, 40), 100, 333, 1000] * 6:
        base = np.unique(draw.integers(0, 1 << 63, n).astype(np.uint64))
        gone = draw.integers(0, n // 5 + 1)
        more = draw.integers(0, n // 4 + 1)
        other = np.unique(np.concatenate([base[draw.permutation(len(base))[gone:]], draw.integers(0, 1 << 63, more).astype(np.uint64)]))
        both = len(np.intersect1d(base, other))
        if 5 * both < 4 * (len(base) + len(other) - both):
            continue
        row, key = bands.keys(np.concatenate([base, other]), np.array([len(base), len(other)]))
        assert set(key[row == 0].tolist()) & set(key[row == 1].tolist())


def test_texts_that_are_near_but_not_similar_hand_on_nothing(spark, monkeypatch):
    draw = random.Random(24)
    base = [f"w{k}" for k in range(400)]
    # some 10 words of 400 are others: two texts share about 0.6 of their shingles
    texts = [" ".join(edited(draw, base, 10)) for _ in range(300)]
    seen, n = links_of(spark, texts, monkeypatch)
    assert n == 300 and seen[-1] == 0 and seen[0] < 10 * 300


def test_many_near_copies_hand_on_a_forest(spark, monkeypatch):
    draw = random.Random(25)
    base = [f"w{k}" for k in range(400)]
    texts = [" ".join(edited(draw, base, draw.randint(1, 3))) for _ in range(600)]
    seen, n = links_of(spark, texts, monkeypatch)
    assert n == 1 and seen[-1] < 2 * 600


def test_nulls_repeats_and_no_rows(spark):
    rows = [(None, "a b c"), (5, "a b c"), (5, "a b c"), (None, None), (7, "x y " * 100_000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = sorted(((r["doc_id"], r["component_id"]) for r in similar_sets.similar_groups(docs).collect()), key=str)
    assert found == [(5, 5), (5, 5), (7, 7), (None, 5), (None, None)]
    assert similar_sets.similar_groups(docs.limit(0)).count() == 0


def test_the_stage_keeps_columns_of_any_name(spark):
    docs = documents(spark, [(1, "a b c d e f"), (2, "a b c d e f"), (3, None), (3, None)])
    for name in ("key", "row", "__key", "id", "node", "component_id"):
        docs = docs.selectExpr("*", f"doc_id as `{name}`")
    found = sorted(corpus_pipeline.near_duplicates(spark, docs, "").collect(), key=lambda r: r["doc_id"])
    assert [tuple(r) for r in found] == [(1, "a b c d e f", "en", "web", 11, *[1] * 6), (3, None, "en", "web", 0, *[3] * 6)]
    kept = corpus_pipeline.language(spark, docs, "")
    assert kept.columns == docs.columns


def test_firsts_are_shared_by_all_similar_sets():
    draw = np.random.default_rng(26)
    often = draw.permutation(np.unique(draw.integers(0, 1 << 63, 400).astype(np.uint64)))
    tried = 0
    for n in [*range(1, 40), 100, 333] * 6:
        some = draw.choice(often, draw.integers(0, n + 1))
        base = np.unique(np.concatenate([some, draw.integers(0, 1 << 63, n - len(some)).astype(np.uint64)]))
        gone, more = draw.integers(0, n // 5 + 1), draw.integers(0, n // 4 + 1)
        other = np.unique(np.concatenate([base[draw.permutation(len(base))[gone:]], draw.choice(often, more)]))
        both = len(np.intersect1d(base, other))
        if 5 * both < 4 * (len(base) + len(other) - both):
            continue
        for order in (similar_sets.Order(often), similar_sets.Order(often[:0])):
            row, key = order.firsts(np.concatenate([base, other]), np.array([len(base), len(other)]), (4, 5))
            assert set(key[row == 0].tolist()) & set(key[row == 1].tolist())
            assert (row == 0).sum() == len(base) - -(-4 * len(base) // 5) + 1
        tried += 1
    assert tried > 100


@pytest.mark.parametrize("lines", [0, 1])
def test_sets_without_a_common_first_shingle_never_meet(spark, monkeypatch, lines):
    """Beside some similar texts, a line that all texts share makes no two of them meet."""
    from medoria.llm import simhash

    draw = random.Random(27)
    line = " ".join(f"l{k}" for k in range(9)) + " "
    texts = [line * lines + " ".join(f"w{draw.randint(0, 10**9)}" for _ in range(60)) for _ in range(400)]
    texts += [texts[0] + " x", texts[0] + " y", texts[1] + " z"]
    met = {}
    inner = simhash.materialise
    monkeypatch.setattr(simhash, "materialise", lambda df, label: (out := inner(df, label), met.update({label: out.count()}))[0])
    docs = spark.createDataFrame([*enumerate(texts)], "doc_id long, text string")
    found = similar_sets.similar_groups(docs, radius=corpus_pipeline.RADIUS).collect()
    assert {r["doc_id"]: r["component_id"] for r in found} == {**{k: k for k in range(400)}, 400: 0, 401: 0, 402: 1}
    # rows of the five texts alone, some for each of their keys at most
    assert met.keys() == {"met"} and met["met"] < 5 * 15


@pytest.mark.parametrize("most", [2, 7, 1000])
def test_candidates_are_the_near_sets_with_a_common_key(spark, monkeypatch, most):
    from medoria.llm import simhash

    monkeypatch.setattr(simhash, "_ROWS_AT_ONCE", 50)
    monkeypatch.setattr(simhash, "_FEW", 10)
    draw = random.Random(28)
    centres = [[draw.getrandbits(64) for _ in range(4)] for _ in range(5)]
    rows, keys = {}, {}
    for point in range(150):
        words = list(draw.choice(centres))
        for _ in range(draw.randint(0, 50)):
            words[draw.randrange(4)] ^= 1 << draw.randrange(64)
        rows[point] = [*words, draw.randint(80, 130)]
        keys[point] = {draw.randint(1, draw.choice((3, 60, 400))) for _ in range(draw.randint(0, 6))}

    def near(a, b):
        apart = [(x ^ y).bit_count() for x, y in zip(rows[a][:4], rows[b][:4])]
        least, largest = sorted((rows[a][4], rows[b][4]))
        return bool(keys[a] & keys[b]) and apart[0] <= 22 and sum(apart) <= 70 and 5 * least >= 4 * largest

    signed = {k: [*(w - (w >> 63 << 64) for w in r), k] for k, r in rows.items()}
    distinct = spark.createDataFrame([*signed.items()], "point long, fingerprint array<long>")
    # copies of a set repeat its keys
    postings = spark.createDataFrame([(k, p) for p in rows for k in keys[p] for _ in range(1 + p % 3)], "key long, point long")
    found = simhash.candidates(postings, distinct, 22, 70, (4, 5), most).collect()
    assert all(near(r["u"], r["v"]) for r in found)
    linked = {frozenset((r["u"], r["v"])) for r in found}
    expected = groups([*rows], {p: p for p in rows}, near)
    assert groups([*rows], {p: p for p in rows}, lambda a, b: frozenset((a, b)) in linked) == expected
    assert 20 < len(set(expected.values())) < 140
