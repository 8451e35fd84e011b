from __future__ import annotations

import random

from medoria.llm import langid
from medoria.llm.common import bounded_sample, held_out
from pyspark.sql import functions as F

PARTS = {"aa": ["ra", "ka", "ta", "na"], "bb": ["öst", "ünd", "grü", "ßen"], "cc": ["ci", "tion", "que", "ue"]}


def text(draw, language, n=40):
    return " ".join("".join(draw.choice(PARTS[language]) for _ in range(draw.randint(1, 4))) for _ in range(n))


def docs(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, score string")


def test_pure_and_mixed_texts(spark):
    draw = random.Random(1)
    rows = [(k, text(draw, name), name, "x") for k, name in enumerate(["aa", "bb", "cc"] * 30)]
    model = langid.fit_on_sample(docs(spark, [*rows, (500, None, "aa", ""), (501, "x", None, "")]))
    assert model[0] == ["aa", "bb", "cc"]
    mixed = text(draw, "aa", 30) + " " + text(draw, "cc", 60)
    asked = [(1, text(draw, "bb"), None, ""), (2, mixed, None, ""), (3, None, "aa", ""), (4, " 12 !", "aa", ""), (4, "", "aa", "")]
    found = {(r["doc_id"], k): r for k, r in enumerate(langid.identify(docs(spark, asked).coalesce(1), model).collect())}
    rows = list(found.values())
    assert [r["lang_pred"] for r in rows] == ["bb", "cc", "und", "und", "und"]
    assert rows[0]["score"] > 0.95 and [r["score"] for r in rows[2:]] == [0, 0, 0]
    assert set(rows[1]["mixture"]) == {"aa", "cc"} and 0.5 < rows[1]["mixture"]["cc"] < 0.9


def test_rare_languages_are_learnt(spark):
    draw = random.Random(3)
    rows = [(k, text(draw, "aa", 6), "aa", "") for k in range(3000)] + [(5000 + k, text(draw, "cc", 6), "cc", "") for k in range(4)]
    rows += [(9000, text(draw, "aa", 6), "aa", "")] * 500
    model = langid.fit_on_sample(docs(spark, rows), fit_rows=40)
    assert model[0] == ["aa", "cc"]
    asked = [(k, text(draw, name, 20), None, name) for k, name in enumerate(["aa", "cc"] * 5)]
    assert all(r["lang_pred"] == asked[r["doc_id"]][3] for r in langid.identify(docs(spark, asked), model).collect())


def test_long_texts_are_taken_whole(spark):
    draw = random.Random(4)
    model = langid.fit_on_sample(docs(spark, [(k, text(draw, name), name, "") for k, name in enumerate(["aa", "bb"] * 9)]))
    long = text(draw, "aa", 20_000) + " " + text(draw, "bb", 60_000)
    (row,) = langid.identify(docs(spark, [(1, long, None, "")]), model).collect()
    assert row["lang_pred"] == "bb" and set(row["mixture"]) == {"aa", "bb"}


def test_nothing_learnt_and_no_rows(spark):
    model = langid.fit_on_sample(docs(spark, [(1, "abc", None, "")]))
    assert [r["lang_pred"] for r in langid.identify(docs(spark, [(1, "abc", None, "")]), model).collect()] == ["und"]
    assert langid.identify(docs(spark, []), model).count() == 0


def test_sample_is_bounded_and_depends_on_keys(spark):
    rows = spark.range(10_000).withColumnRenamed("id", "k")
    sample = {r["k"] for r in bounded_sample(rows, "k", 500).collect()}
    assert 400 < len(sample) < 600 and sample == {r["k"] for r in bounded_sample(rows.repartition(5), "k", 500).collect()}
    assert bounded_sample(rows, "k", 10_000).count() == 10_000


def test_held_out_rows(spark):
    import zlib

    found = spark.range(50).select("id", held_out(F.col("id")).alias("h")).collect()
    assert [r["h"] for r in found] == [zlib.crc32(str(r["id"]).encode()) % 4 == 2 for r in found]
