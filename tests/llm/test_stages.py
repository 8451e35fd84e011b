"""Stages of the pipeline beside brute force, with the parameters they run with."""

from __future__ import annotations

import random

import corpus_pipeline
from tests.llm.test_registered import check_pieces
from tests.llm.test_suffixes import awkward, covered

COLUMNS = "doc_id long, text string, lang string, source string, n_chars long"


def documents(spark, texts):
    rows = [(k, t, "en", "web", len(t or "")) for k, t in texts]
    return spark.createDataFrame(rows, COLUMNS).repartition(3)


def shingles(text):
    words = text.lower().split()
    return {tuple(words[k : k + 5]) for k in range(max(1, len(words) - 4))} if words else set()


def smallest_of_groups(texts):
    """Single links of all pairs with a set similarity of 0.8."""
    sets = {k: shingles(t) for k, t in texts}
    root = {k: k for k in sets}

    def find(k):
        while root[k] != k:
            k = root[k]
        return k

    for a in sets:
        for b in sets:
            x, y = sets[a], sets[b]
            if a < b and 5 * len(x & y) >= 4 * len(x | y):
                p, q = sorted((find(a), find(b)))
                root[q] = p
    return {k for k in root if find(k) == k}


def edited(draw, words, edits):
    words = list(words)
    for _ in range(edits):
        words[draw.randrange(len(words))] = f"x{draw.randint(0, 10**6)}"
    return words


def near_and_not(draw):
    """Pairs, stars and chains of copies at similarities from 0.5 to 1, with repeated lines."""
    texts = []
    for _ in range(25):
        line = [f"l{draw.randint(0, 10**6)}" for _ in range(12)]
        base = [f"w{draw.randint(0, 10**6)}" for _ in range(draw.choice((8, 9, 30, 150, 400)))]
        base += line * draw.choice((0, 0, 1, 30))
        texts.append(base)
        for _ in range(draw.randint(1, 8)):
            base = edited(draw, draw.choice((base, texts[-1])), draw.randint(0, 1 + len(base) // 25))
            texts.append(base)
    draw.shuffle(texts)
    return [(k, " ".join(t)) for k, t in enumerate(texts)] + [(1000, " "), (1001, ""), (1002, "one two"), (1003, "One  two")]


def test_near_duplicates_are_similar(spark):
    texts = near_and_not(random.Random(11))
    found = corpus_pipeline.near_duplicates(spark, documents(spark, texts), "").collect()
    assert {r["doc_id"] for r in found} == smallest_of_groups(texts)
    assert len(found) < len(texts) - 20


def test_contamination_takes_every_document_with_a_window(spark, tmp_path):
    draw = random.Random(12)

    def some(n):
        return [f"w{draw.randint(0, 40)}" for _ in range(n)]

    items = [some(draw.choice((3, 9, 10, 11, 25))) for _ in range(20)]
    spark.createDataFrame([(k, " ".join(t)) for k, t in enumerate(items)], "item_id long, text string").write.parquet(
        f"{tmp_path}/benchmark.parquet"
    )
    texts = [(1000, None), (1001, "")]
    for k in range(120):
        item = draw.choice(items)
        at, n = draw.randrange(len(item)), draw.randint(2, 14)
        texts.append((k, " ".join([*some(draw.randint(0, 30)), *item[at : at + n], *some(draw.randint(0, 30))])))
    windows = {" ".join(t[k : k + 10]) for t in items for k in range(max(1, len(t) - 9))}
    clean = {k for k, t in texts if not any(f" {w} " in f" {t or ''} " for w in windows)}
    found = corpus_pipeline.contamination(spark, documents(spark, texts), str(tmp_path)).collect()
    assert {r["doc_id"] for r in found} == clean and 20 < len(clean) < len(texts) - 10


def test_packing_keeps_every_id(spark):
    draw = random.Random(13)
    texts = {k: " ".join(f"w{draw.randint(0, 999)}" for _ in range(draw.choice((0, 1, 40, 3000)))) for k in range(40)}
    check_pieces(corpus_pipeline.pack(spark, documents(spark, texts.items()), "").collect(), texts)


def test_repeats_are_cut_byte_by_byte(spark):
    texts = [(t or "").encode("ascii", "ignore").decode() for t in awkward(1)]
    marks = covered([t.encode() for t in texts])
    found = corpus_pipeline.repeats(spark, documents(spark, enumerate(texts)), "").collect()
    kept = {k: "".join(c for c, m in zip(t, marks[k]) if not m) for k, t in enumerate(texts)}
    assert {r["doc_id"]: r["text"] for r in found} == kept and len(found) == len(texts)
    assert all(r["n_chars"] == len(r["text"]) for r in found)
