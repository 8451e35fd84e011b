from __future__ import annotations

import random

import pytest

from medoria.llm import decontaminate


def words(text):
    out, word = [], ""
    for c in (text or "") + " ":
        if "A" <= c <= "Z":
            c = chr(ord(c) + 32)
        if c.isdigit() and ord(c) < 128 or "a" <= c <= "z" or ord(c) > 127:
            word += c
        else:
            out += [word] if word else []
            word = ""
    return out


def brute(docs, items, slack=0):
    out = {}
    for name, text in docs:
        w = words(text)
        hit, exact, near = set(), set(), set()
        for item, t in items:
            v = words(t)
            for k in range(max(1, len(v) - 9) if v else 0):
                window = v[k : k + 10]
                for s in range(-slack, len(w) + slack):
                    if w[max(0, s) : max(0, s) + len(window)] == window and s >= 0:
                        hit.update(range(s, s + len(window)))
                        exact.add(item)
                    if slack and all(
                        x in w[max(0, s + j - slack) : max(0, s + j + slack + 1)] for j, x in enumerate(window)
                    ):
                        near.add(item)
        out[name] = (len(w), hit, sorted(exact - {None}), sorted(near - {None}))
    return out


def rows():
    draw = random.Random(2)
    vocabulary = ["der", "Die", "it's", "x9", "été", "日本", "a", "b", "c"]
    items = [(k, " ".join(draw.choice(vocabulary) for _ in range(draw.randint(1, 16)))) for k in range(12)]
    items += [(20, None), (21, "-- !"), (3, "one more item with the id three"), (None, "no id at all")]
    docs = [(0, None), (1, ""), (2, "?!"), (3, "No-id at ALL, one more item with the id three")]
    for k in range(4, 24):
        parts = []
        for _ in range(draw.randint(0, 6)):
            own = [draw.choice(vocabulary) for _ in range(draw.randint(1, 12))]
            part = words(draw.choice(items)[1]) if draw.random() < 0.6 else own
            if draw.random() < 0.3 and len(part) > 2:
                part.insert(2, "zwischen")
            parts.append(draw.choice([", ", " ", "\n"]).join(part).upper())
        docs.append((k, " ".join(parts)))
    return docs, items


@pytest.mark.parametrize("block_bytes", [1 << 24, 100])
@pytest.mark.parametrize("slack", [0, 2])
def test_equals_brute_force(spark, block_bytes, slack):
    docs, items = rows()
    found = decontaminate.contamination(
        spark.createDataFrame([(*d, 1) for d in docs], "doc_id long, text string, spans int").repartition(3),
        spark.createDataFrame([(*i, 1) for i in items], "item_id long, text string, words int"),
        slack=slack,
        block_bytes=block_bytes,
    ).collect()
    expected = brute(docs, items, slack)
    assert len(found) == len(docs)
    for r in found:
        hit = {k for s in r["spans"] for k in range(s["first"], s["last"] + 1)}
        assert (r["n_words"], hit, r["items"], r["near"]) == expected[r["doc_id"]]
        assert all(a["last"] + 1 < b["first"] for a, b in zip(r["spans"], r["spans"][1:]))
    assert any(e[2] for e in expected.values()) and (not slack or any(len(e[3]) > len(e[2]) for e in expected.values()))


def test_phrases_do_not_cross_documents(spark):
    docs = spark.createDataFrame([(1, "one two three"), (2, "four five six"), (2, "three four")], "doc_id long, text string")
    items = spark.createDataFrame([("i", "three four")], "item_id string, text string")
    found = decontaminate.contamination(docs.coalesce(1), items).collect()
    assert sorted((r["doc_id"], r["items"]) for r in found) == [(1, []), (2, []), (2, ["i"])]


@pytest.mark.parametrize("kind", ["smallint", "int", "decimal(9,0)", "string", "date"])
def test_items_of_any_type(spark, kind):
    docs = spark.createDataFrame([(1, "one two three"), (1, "one two three"), (None, "two")], "doc_id long, text string")
    items = spark.createDataFrame([("2021-01-02" if kind == "date" else "12", "two three")], "item_id string, text string")
    items = items.selectExpr(f"cast(item_id as {kind}) as item_id", "text")
    name = items.first()["item_id"]
    for block_bytes in (1 << 24, 4):
        found = decontaminate.contamination(docs.repartition(2), items, block_bytes=block_bytes).collect()
        assert sorted((r["doc_id"] or 0, r["items"]) for r in found) == [(0, []), (1, [name]), (1, [name])]


def test_empty_tables(spark):
    docs = spark.createDataFrame([(1, "one two")], "doc_id long, text string")
    items = spark.createDataFrame([(1, "one two")], "item_id long, text string")
    assert decontaminate.contamination(docs.limit(0), items).count() == 0
    (row,) = decontaminate.contamination(docs, items.limit(0)).collect()
    assert (row["n_words"], row["spans"], row["items"]) == (2, [], [])
