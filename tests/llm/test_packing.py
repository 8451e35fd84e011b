from __future__ import annotations

from itertools import combinations

import numpy as np
import pytest
from pyspark.sql import functions as F

from medoria.llm import packing
from medoria.llm.queries import piece_columns, tokenizer_files

from .test_registered import check_pieces


@pytest.mark.parametrize("seed", range(8))
def test_cuts_are_the_cheapest(seed):
    draw = np.random.default_rng(seed)
    places = np.cumsum(draw.integers(1, 10, 11))
    penalties = draw.integers(0, 4, 11).astype(float)
    capacity = 20

    def cost(cuts):
        edges = [0, *cuts]
        if any(b - a > capacity for a, b in zip(edges, [*cuts, places[-1]])):
            return np.inf
        price = dict(zip(places.tolist(), penalties))
        return sum(capacity - (b - a) + price[b] for a, b in zip(edges, edges[1:]))

    best = min(cost(c) for n in range(len(places) + 1) for c in combinations(places.tolist(), n))
    assert cost(packing.best_cuts(places, penalties, capacity)) == best


def test_awkward_rows(spark):
    texts = {
        1: None,
        2: "",
        3: "no sentence at all " * 700,
        4: "One. Two! Three? " * 900,
        5: "日本語 и кириллица <|endoftext|> x",
        6: " \n\t ",
        7: "\n" * 300_000 + "x",
        8: "x" * 20_000 + "!" * 20_000,
    }
    rows = [(k, v, "other") for k, v in texts.items()]
    docs = spark.createDataFrame(rows, "doc_id long, text string, ids string").coalesce(1)
    check_pieces(piece_columns(packing.pack(docs, **tokenizer_files())).collect(), texts)
    small = packing.pack(docs, **tokenizer_files(), plan_tokens=100)
    check_pieces(piece_columns(small).collect(), texts)


def test_repeated_rows_null_ids_and_no_rows(spark):
    docs = spark.createDataFrame([(None, "a b"), (7, "a b"), (7, "a b")], "doc_id long, text string").coalesce(1)
    rows = packing.pack(docs, **tokenizer_files()).groupBy("doc_id").agg(F.sum("length").alias("n")).collect()
    assert {r["doc_id"]: r["n"] for r in rows} == {None: 3, 7: 6}
    assert packing.pack(docs.limit(0), **tokenizer_files()).count() == 0
