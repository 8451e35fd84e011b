"""Quality scores by Bradley-Terry pairwise ranking.

A document's strength is a weighted sum of features of its text. For pairs of a
preferred document (label 1) and another one (label 0), the chance that the first
wins is the logistic function of the difference of their strengths; the weights
minimise the logistic loss on the differences of their features. The cut is a
quantile of the fitted rows' strengths: by default that of the share of label 0 among them, so
that as many rows lie below it as are not preferred.
A score is the logistic function of the distance to it, shifted so that it is
THRESHOLD there.

Only the fit uses labels, and it uses all of them. Features of the labelled rows are written in blocks of
about BLOCK_ROWS rows, both labels in each; a row meets others of its block. Every step of the
minimisation and of the search for the quantile is a pass over the blocks that sends sums
of fixed size to the driver, so neither rows nor their features reach it. Scoring is one
pass over the texts, without a shuffle.

Defined results: null and empty texts have the features of no words and a score
like any other text; without labels of both kinds every score is the one label, or
0.5 if there is none; rows with an id of several labels count for each; repeated
rows are scored alike; equal strengths at the cut lie above it; very long texts are read
whole, a text at a time; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from medoria.operators import dense_number
from medoria.work import materialise

THRESHOLD = 0.7
BLOCK_ROWS = 8192
BINS = 4096
PAIRS_EACH = 8
RIDGE = 1e-3
N_FEATURES = 16

_SPACE, _UPPER, _LOWER, _DIGIT, _STOP, _MARK = range(1, 7)
_KIND = np.array(
    [
        _SPACE
        if b in b" \t\n\r\x0b\x0c"
        else _UPPER
        if 65 <= b <= 90
        else _LOWER
        if 97 <= b <= 122 or b >= 128
        else _DIGIT
        if 48 <= b <= 57
        else _STOP
        if b in b".,;:'\"-"
        else _MARK
        for b in range(256)
    ]
)


def features(text: bytes) -> np.ndarray:
    """What a text looks like: lengths, kinds of characters, repetition, shape of words and lines."""
    if not text:
        return np.zeros(N_FEATURES)
    every = np.bincount(np.frombuffer(text, np.uint8), minlength=256)
    kinds = np.bincount(_KIND, weights=every, minlength=7)
    solid = max(1.0, kinds.sum() - kinds[_SPACE])
    words = text.split()
    n = max(1, len(words))
    seen = Counter(words)
    again = sum(a == b for a, b in zip(words, words[1:]))
    marked = sum(not (w[-1:].isalnum() or w[-1] >= 128 or w[-1:] in b".,") for w in words)
    lone = sum(len(w) == 1 for w in words)
    return np.array(
        [
            np.log1p(n),
            solid / n / 10,
            kinds[_UPPER] / solid,
            kinds[_DIGIT] / solid,
            kinds[_STOP] / solid,
            np.sqrt(kinds[_MARK] / solid),
            np.sqrt(every[ord("|")] / n),
            np.sqrt(every[ord("!")] / n),
            np.sqrt(again / n),
            len(seen) / n,
            max(seen.values(), default=0) / n,
            marked / n,
            lone / n,
            np.sqrt(every[ord("\n")] / n),
            every[ord(".")] / n,
            np.sqrt(len(words) - len(seen)) / np.sqrt(n),
        ]
    )


@dataclass
class Ranking:
    """Weights of standardised features, and the strength at which the score is THRESHOLD."""

    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    cut: float
    alone: float | None = None

    def strength(self, x: np.ndarray) -> np.ndarray:
        return _curved((x - self.mean) / self.scale) @ self.weights

    def score(self, x: np.ndarray) -> np.ndarray:
        if self.alone is not None:
            return np.full(len(x), self.alone)
        z = self.strength(x) - self.cut + np.log(THRESHOLD / (1 - THRESHOLD))
        return 1 / (1 + np.exp(-np.clip(z, -500, 500)))


def _curved(z: np.ndarray) -> np.ndarray:
    z = np.clip(z, -6, 6)
    return np.concatenate([z, z * z], axis=1)


def pairs_of(good: np.ndarray, bad: np.ndarray) -> np.ndarray:
    """Pairs (preferred, other) of rows: each row meets PAIRS_EACH of the other kind."""
    draw = np.random.default_rng(0)
    won = np.stack([np.repeat(good, PAIRS_EACH), draw.choice(bad, len(good) * PAIRS_EACH)])
    lost = np.stack([draw.choice(good, len(bad) * PAIRS_EACH), np.repeat(bad, PAIRS_EACH)])
    return np.concatenate([won, lost], axis=1)


Step = Callable[[np.ndarray, np.ndarray, np.ndarray], np.ndarray]
Each = Callable[[Step], list[np.ndarray]]


def _sum(parts: list[np.ndarray]) -> np.ndarray:
    return np.sum(parts, axis=0)


def _keys(s: np.ndarray) -> np.ndarray:
    """Unsigned integers in the order of the doubles."""
    bits = (s + 0.0).view(np.uint64)
    top = np.uint64(1 << 63)
    return np.where(bits & top, ~bits, bits | top)


def _value(key: int) -> float:
    top = 1 << 63
    bits = key ^ top if key & top else key ^ ((1 << 64) - 1)
    return float(np.array([bits], np.uint64).view(np.float64)[0])


def _smallest(each: Each, strength: Callable[[np.ndarray], np.ndarray], place: int) -> float:
    """The strength with ``place`` of the rows before it, ties included: counts in bins of a range that narrows."""
    low, high = 0, (1 << 64) - 1
    while low < high:
        width = (high - low) // BINS + 1

        def count(x: np.ndarray, label: np.ndarray, own: np.ndarray) -> np.ndarray:
            keys = _keys(strength(x[own]))
            keys = keys[(keys >= np.uint64(low)) & (keys <= np.uint64(high))]
            return np.bincount(((keys - np.uint64(low)) // np.uint64(width)).astype(np.int64), minlength=BINS)

        upto = np.cumsum(_sum(each(count)))
        k = int(np.searchsorted(upto, place, side="right"))
        place -= int(upto[k - 1]) if k else 0
        low, high = low + k * width, min(high, low + (k + 1) * width - 1)
    return _value(low)


def _cut(each: Each, strength: Callable[[np.ndarray], np.ndarray], n: int, quantile: float) -> float:
    """A strength with the share ``quantile`` of the rows below it, half-way between its neighbours."""
    k = min(max(round(quantile * n), 0), n)
    below = _smallest(each, strength, max(k - 1, 0))

    def beyond(x: np.ndarray, label: np.ndarray, own: np.ndarray) -> np.ndarray:
        s = strength(x[own])
        return np.array([(s <= below).sum(), s[s > below].min(initial=np.inf)])

    parts = np.array(each(beyond))
    if k == 0:
        return below - 1
    if k == n:
        return below + 1
    above = below if parts[:, 0].sum() > k else parts[:, 1].min()
    return float((below + above) / 2)


def _learn(each: Each, n: int, n_bad: int, quantile: float | None) -> Ranking:
    """Fit to blocks of (feature rows, labels, whether a row is counted here); ``each`` runs a step on all of them."""
    mean = _sum(each(lambda x, label, own: x[own].sum(axis=0))) / n
    scale = np.sqrt(_sum(each(lambda x, label, own: ((x[own] - mean) ** 2).sum(axis=0))) / n) + 1e-9
    w = np.zeros(2 * N_FEATURES)
    for _ in range(25):

        def slopes(x: np.ndarray, label: np.ndarray, own: np.ndarray) -> np.ndarray:
            z = _curved((x - mean) / scale)
            pairs = pairs_of(np.flatnonzero(label == 1), np.flatnonzero(label == 0))
            gap = z[pairs[0]] - z[pairs[1]]
            p = 1 / (1 + np.exp(np.clip(gap @ w, -30, 30)))  # chance that the preferred one loses
            curve = (gap * (p * (1 - p))[:, None]).T @ gap
            return np.concatenate([[len(gap)], gap.T @ p, curve.ravel()])

        found = _sum(each(slopes))
        slope = found[1 : len(w) + 1] / found[0] - RIDGE * w
        curve = found[len(w) + 1 :].reshape(len(w), -1) / found[0] + RIDGE * np.eye(len(w))
        step = np.linalg.solve(curve, slope)
        w = w + step
        if np.abs(step).max() < 1e-6:
            break
    cut = _cut(each, lambda x: _curved((x - mean) / scale) @ w, n, n_bad / n if quantile is None else quantile)
    return Ranking(mean, scale, w, cut)


def _alone(n_good: int, n_bad: int) -> Ranking:
    """Without labels of both kinds."""
    score = 1.0 if n_good else 0.0 if n_bad else 0.5
    return Ranking(np.zeros(N_FEATURES), np.ones(N_FEATURES), np.zeros(2 * N_FEATURES), 0.0, score)


def rank(x: np.ndarray, label: np.ndarray, quantile: float | None = None) -> Ranking:
    """Fit to feature rows and their labels (0 or 1), as one block."""
    n_good, n_bad = int((label == 1).sum()), int((label == 0).sum())
    if not n_good or not n_bad:
        return _alone(n_good, n_bad)
    every = np.ones(len(x), bool)
    return _learn(lambda step: [step(x, label, every)], len(x), n_bad, quantile)


def _features_of(rows: DataFrame) -> DataFrame:
    """(id, x) for a table of (id, text as bytes)."""
    kind = rows.schema["id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = [features(t.as_py()).tolist() for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(x, pa.list_(pa.float64()))], names=["id", "x"])

    return rows.mapInArrow(run, f"id {kind}, x array<double>")


def _rows(docs: DataFrame, id: str, text: str) -> DataFrame:
    return docs.select(F.col(id).alias("id"), F.coalesce(F.col(text), F.lit("")).cast("binary").alias("text"))


def _blocks(rows: DataFrame, n_good: int, n_bad: int) -> DataFrame:
    """(block, x, label, own): one row per block, its feature rows and labels as bytes in the order of the id.

    Rows of a label are dealt in turn, so a block has its share of both. Where a label has fewer rows than there
    are blocks, its rows are repeated in turn and ``own`` in the first block alone.
    """
    n = max(1, -(-(n_good + n_bad) // BLOCK_ROWS))
    first = F.when(F.col("label") == 1, F.lit(n_bad)).otherwise(F.lit(0))
    of_label = F.when(F.col("label") == 1, F.lit(n_good)).otherwise(F.lit(n_bad)).cast("bigint")
    numbered = dense_number(rows, ["label", "id"], "number").withColumn("number", F.col("number") - 1 - first)
    several = F.sequence("number", F.lit(n - 1).cast("bigint"), of_label)
    places = F.when(of_label < n, several).otherwise(F.array(F.col("number") % n))
    dealt = numbered.select(
        F.explode(places).alias("block"), "id", "label", "x", (F.col("number") % n).alias("home")
    )

    def pack(group: pa.Table) -> pa.Table:
        group = group.sort_by([("id", "ascending"), ("label", "ascending")])
        x = np.array(group["x"].to_pylist(), float)
        label = np.array(group["label"].to_pylist(), np.int8)
        own = np.array(group["home"].to_pylist()) == np.array(group["block"].to_pylist())
        held = [[group["block"][0].as_py()], [x.tobytes()], [label.tobytes()], [own.tobytes()]]
        kinds = (pa.int64(), pa.binary(), pa.binary(), pa.binary())
        return pa.table([pa.array(v, k) for v, k in zip(held, kinds)], names=["block", "x", "label", "own"])

    return materialise(dealt.groupBy("block").applyInArrow(pack, "block long, x binary, label binary, own binary"), "blocks")


def _each(blocks: DataFrame) -> Each:
    """Runs a step on every block in the tasks; the sums of a block, of fixed size, return in the order of the blocks."""

    def run(step: Step) -> list[np.ndarray]:
        def over(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for block, x, label, own in zip(*(batch.column(k) for k in range(4))):
                    features = np.frombuffer(x.as_py(), float).reshape(-1, N_FEATURES)
                    found = step(features, np.frombuffer(label.as_py(), np.int8), np.frombuffer(own.as_py(), bool))
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([block.as_py()]), pa.array([found.astype(float).tolist()], pa.list_(pa.float64()))],
                        names=["block", "found"],
                    )

        sent = blocks.mapInArrow(over, "block long, found array<double>").orderBy("block").collect()
        return [np.array(r["found"]) for r in sent]

    return run


def fit(
    docs: DataFrame,
    labels: DataFrame,
    id: str = "doc_id",
    text: str = "text",
    label: str = "quality",
    quantile: float | None = None,
) -> Ranking:
    """Learn from all labels; rows without a label (0 or 1) are passed over.

    ``quantile``: the share of the labelled rows that is to lie below the cut.
    """
    known = labels.select(F.col(id).alias("id"), F.col(label).alias("label")).where(F.col("label").isin(0, 1))
    known = known.withColumn("label", F.col("label").cast("int")).distinct()
    # features before the join: the texts themselves are not shuffled
    found = _features_of(_rows(docs, id, text)).join(known.select("id").distinct(), "id", "left_semi")
    # one row per id, however often it is repeated
    mean = [F.avg(F.col("x")[k]).alias(f"x{k}") for k in range(N_FEATURES)]
    rows = found.groupBy("id").agg(*mean).join(known, "id")
    rows = materialise(rows.select("id", "label", F.array(*[f"x{k}" for k in range(N_FEATURES)]).alias("x")), "labelled")
    n = rows.agg(F.count_if(F.col("label") == 1).alias("good"), F.count_if(F.col("label") == 0).alias("bad")).first()
    if not n["good"] or not n["bad"]:
        return _alone(n["good"], n["bad"])
    return _learn(_each(_blocks(rows, n["good"], n["bad"])), n["good"] + n["bad"], n["bad"], quantile)


def score(docs: DataFrame, ranking: Ranking, id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: the id and ``score``, from 0 to 1."""
    rows = _rows(docs, id, text)
    kind = rows.schema["id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = np.array([features(t.as_py()) for t in batch.column(1)]).reshape(-1, N_FEATURES)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(ranking.score(x), pa.float64())], names=["id", "score"])

    return rows.mapInArrow(run, f"id {kind}, score double").withColumnRenamed("id", id)
