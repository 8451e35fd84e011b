from __future__ import annotations

import random
import sys
from collections import Counter

import pytest
from pyspark.sql import functions as F

from medoria.operators import (
    broadcastable,
    dense_number,
    keep_one,
    lookup,
    number_within,
    partition_advice,
    partition_column,
    unique_names,
)
from medoria.operators.lookup import heavy_keys


def rows(df):
    return Counter(tuple(row) for row in df.collect())


@pytest.fixture(scope="module")
def hot(spark):
    """A third of the rows under one key, a third under NULL, the rest spread."""

    def key(i):
        return {0: "hot", 1: None}.get(i % 3, f"k{i % 50}")

    return spark.createDataFrame([(i, key(i)) for i in range(3000)], "i int, k string").repartition(5)


@pytest.fixture(scope="module")
def others(spark):
    pairs = [("hot", 1), ("hot", 2), ("k2", 3), ("unused", 4), (None, 5)]
    return spark.createDataFrame(pairs, "k string, v int")


def test_broadcastable_measures_rows_and_bytes(others, monkeypatch):
    assert broadcastable(others)
    assert broadcastable(others.limit(0))
    module = sys.modules["medoria.operators.lookup"]
    monkeypatch.setattr(module, "MAX_BROADCAST_ROWS", 4)
    assert not broadcastable(others)
    monkeypatch.undo()
    monkeypatch.setattr(module, "MAX_BROADCAST_BYTES", 40)
    assert not broadcastable(others)


@pytest.mark.parametrize("spread_by", [None, "i"])
def test_lookup_is_a_left_join(hot, others, few_are_heavy, spread_by):
    expected = rows(hot.join(others, "k", "left").select("i", "k", "v"))
    got = lookup(hot, others, "k", spread_by)
    assert got.columns == ["k", "i", "v"]
    assert rows(got.select("i", "k", "v")) == expected


def test_lookup_of_crowded_keys(spark, few_are_heavy):
    """Keys with many rows on the right, on the left, on both and on none."""
    left = [(i, k) for i, k in enumerate(["r"] * 3 + ["b"] * 60 + ["l"] * 90 + [None] * 50 + ["none"] * 4)]
    right = [(k, v) for v, k in enumerate(["r"] * 300 + ["b"] * 80 + ["l"] + [None] * 70 + list("xyz"))]
    left = spark.createDataFrame(left, "i int, k string").repartition(3)
    right = spark.createDataFrame(right, "k string, v int").repartition(3)
    expected = rows(left.join(right, "k", "left").select("i", "k", "v"))
    assert rows(lookup(left, right, "k").select("i", "k", "v")) == expected
    assert rows(lookup(left, right, "k", "i").select("i", "k", "v")) == expected


def test_lookup_broadcasts_small_tables(hot, others):
    expected = rows(hot.join(others, "k", "left").select("i", "k", "v"))
    assert rows(lookup(hot, others, "k").select("i", "k", "v")) == expected


def test_few_rows_are_never_heavy(hot):
    assert heavy_keys(hot, "k", 10).isEmpty()


def test_heavy_keys_are_few_and_right(hot, few_are_heavy):
    heavy = {row["_heavy_key"]: row["_parts"] for row in heavy_keys(hot, "k", 10).collect()}
    assert heavy == {"hot": 4, None: 4}


def test_lookup_spreads_the_hot_key(hot, others, spark, few_are_heavy):
    adaptive = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")  # look at the bare partitioning
    spark.conf.set("spark.sql.shuffle.partitions", "16")
    unused = spark.range(500).select(F.concat(F.lit("u"), "id").alias("k"), F.col("id").cast("int").alias("v"))
    unique = others.dropDuplicates(["k"]).union(unused)
    try:
        joined = lookup(hot, unique, "k", "i").hint("merge")
        sizes = joined.groupBy(F.spark_partition_id()).count().agg(F.max("count")).first()[0]
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
        spark.conf.set("spark.sql.adaptive.enabled", adaptive)
    assert sizes < 1000  # the hot key alone has 1000 rows


def test_dense_number_equals_sorted_order(spark):
    words = random.Random(5).sample(range(100_000), 2000)
    df = spark.createDataFrame([(w,) for w in words], "w int").repartition(7)
    numbered = {row["w"]: row["n"] for row in dense_number(df, ["w"], "n").collect()}
    assert numbered == {w: i + 1 for i, w in enumerate(sorted(words))}


def test_dense_number_does_not_depend_on_partitions(spark):
    df = spark.createDataFrame([(i % 97, i) for i in range(1000)], "a int, b int")
    one = rows(dense_number(df.coalesce(1), ["a", "b"], "n"))
    spark.conf.set("spark.sql.shuffle.partitions", "1")
    try:
        single = rows(dense_number(df.repartition(9), ["a", "b"], "n"))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
    assert one == single


def test_dense_number_with_ties_and_nulls(spark):
    data = [("x",)] * 500 + [("a",)] * 3 + [(None,)] * 2
    numbered = dense_number(spark.createDataFrame(data, "w string").repartition(6), ["w"], "n", ties=True)
    got = sorted((row["n"], row["w"]) for row in numbered.collect())
    assert [w for _, w in got] == [None] * 2 + ["a"] * 3 + ["x"] * 500
    assert [n for n, _ in got] == list(range(1, 506))


def test_ties_span_partitions(spark):
    data = spark.range(4000).select(F.lit("same").alias("w"))
    placed = dense_number(data.repartition(8), ["w"], "n", ties=True)
    # the numbers are complete although no partition holds all equal rows
    assert placed.agg(F.count_distinct("n"), F.max("n")).first() == (4000, 4000)


def test_dense_number_of_nothing(spark):
    assert dense_number(spark.createDataFrame([], "w int"), ["w"], "n").count() == 0


@pytest.mark.parametrize("large", [False, True])
def test_number_within(spark, large, request):
    if large:
        request.getfixturevalue("few_are_heavy")
    data = [("hot", i) for i in range(600)] + [(f"g{i % 40}", i) for i in range(600)]
    random.Random(1).shuffle(data)
    df = spark.createDataFrame(data, "g string, i int")
    got = {(row["g"], row["i"]): row["n"] for row in number_within(df, ["g"], ["i"], "n").collect()}
    expected, seen = {}, Counter()
    for g, i in sorted(data):
        seen[g] += 1
        expected[g, i] = seen[g]
    assert got == expected


def test_keep_one_prefers_complete_then_small(spark):
    data = [(1, None, "b"), (1, "z", "b"), (1, "z", "a"), (2, None, None), (2, None, None), (None, "x", "x")]
    df = spark.createDataFrame(data, "k int, a string, b string")
    assert sorted(map(tuple, keep_one(df, "k").collect())) == [(1, "z", "a"), (2, None, None)]


@pytest.mark.parametrize(
    ("n_rows", "n_values", "partitioned"),
    [(10_000, 5, False), (10_001, 99, True), (10_001, 100, False)],
)
def test_partition_advice(spark, n_rows, n_values, partitioned):
    # one of the values is NULL
    value = F.nullif(F.col("id") % n_values, F.lit(0))
    df = spark.range(n_rows).select(value.alias("v"))
    assert tuple(partition_advice(df, "v").first()) == (n_rows, n_values, partitioned)
    assert partition_column(df, "v") == ("v" if partitioned else None)
    assert partition_column(df, None) is None


def brute_force_names(bases):
    """Names in the given order: base names first come, suffixes skip all base names."""
    taken, seen, names = set(bases), set(), []
    counters = Counter()
    for base in bases:
        if base not in seen:
            seen.add(base)
            names.append(base)
            continue
        counters[base] += 1
        while f"{base}_{counters[base]}" in taken:
            counters[base] += 1
        names.append(f"{base}_{counters[base]}")
    return names


@pytest.mark.parametrize(
    "bases",
    [
        ["a", "b", "c"],
        ["x_y_z", "x_y_z"],
        ["a", "a", "a_1", "a", "a_1", "a_3", "a", "a"],
        ["a_1", "a_2", "a", "a", "a"],
        ["a_01", "a", "a", "a_1_1", "a_1", "a_1"],
    ],
)
def test_unique_names(spark, bases):
    df = spark.createDataFrame(list(enumerate(bases)), "i int, base string").repartition(3)
    got = [row["name"] for row in unique_names(df, "base", ["i"], "name").orderBy("i").collect()]
    assert got == brute_force_names(bases)
    assert len(set(got)) == len(bases)


def test_unique_names_at_random(spark):
    rng = random.Random(11)
    bases = [rng.choice(["a", "b", "a_1", "a_2", "a_4", "b_2", "a_1_1"]) for _ in range(200)]
    df = spark.createDataFrame(list(enumerate(bases)), "i int, base string").repartition(4)
    got = [row["name"] for row in unique_names(df, "base", ["i"], "name").orderBy("i").collect()]
    assert got == brute_force_names(bases)


def test_the_session_splits_frequent_keys(hot, others, never_broadcast):
    joined = lookup(hot, others, "k", "i")
    assert joined._jdf.queryExecution().optimizedPlan().toString().count("Join") == 1
    assert rows(joined.select("i", "k", "v")) == rows(hot.join(others, "k", "left").select("i", "k", "v"))


def test_lookup_reads_each_side_twice(hot, others, few_are_heavy):
    """Once for the sketch of its keys, once for the join, however many keys are frequent."""
    for left, right in ((hot, others), (others, hot.withColumnRenamed("i", "v2"))):
        plan = lookup(left, right, "k")._jdf.queryExecution().optimizedPlan().toString()
        assert plan.count("Join") == 3  # the salts of either side, and the join


def test_keys_frequent_on_both_sides(spark, few_are_heavy):
    draw = random.Random(9)
    left = [(i, draw.choice(["x"] * 5 + ["y", "z", "only left", None])) for i in range(400)]
    right = [(draw.choice(["x"] * 3 + ["y"] * 3 + ["only right", None]), v % 7) for v in range(300)]
    left = spark.createDataFrame(left, "i int, k string").repartition(3)
    right = spark.createDataFrame(right, "k string, v int").repartition(3)
    expected = rows(left.join(right, "k", "left").select("i", "k", "v"))
    assert rows(lookup(left, right, "k", "i").select("i", "k", "v")) == expected
