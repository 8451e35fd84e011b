"""Language identification by mixtures of n-gram models.

Every language has a distribution over hashed byte trigrams of lower-cased
letters, counted over labelled rows. A document is a mixture of languages: its
proportions are found by expectation-maximisation over the likelihoods of its
trigrams. The set of languages is chosen by penalised likelihood: the
proportions' largest languages are taken one after the other, and the set with
the best log-likelihood minus half a logarithm of the n-gram count per language
wins. The prediction is the language with the largest proportion in that set.

Scoring is one pass without a shuffle. The model is a table of BINS rows and a
column per language; it is counted from a bounded sample of the labelled rows
(``fit_rows``, a share of it for every language), and that is all that reaches the driver.

Defined results: a text that is null or has no letter is ``und`` with score 0,
and so is every text if nothing was labelled; equal proportions go to the
language that sorts first; repeated rows are scored alike; an empty table gives
no rows; other columns are ignored. Texts of any length are taken whole, one at a
time, as counts of at most BINS trigrams.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BINS = 1 << 14
ROUNDS = 12
MAX_LANGUAGES = 500
UNKNOWN = "und"

# ASCII letters are kept, all other ASCII is a space; bytes of other letters are kept as they are
_LETTERS = bytes(b if b >= 128 or chr(b).isalpha() else 32 for b in range(256))


def _bins(text: str) -> np.ndarray:
    """The bins of a text's trigrams, spaces around words included."""
    raw = b" " + b" ".join(text.lower().encode("utf-8", "replace").translate(_LETTERS).split()) + b" "
    b = np.frombuffer(raw, np.uint8).astype(np.uint32)
    code = b[:-2] * np.uint32(65536) + b[1:-1] * np.uint32(256) + b[2:]
    return (code * np.uint32(2654435761)) >> np.uint32(18)


def _has_letter(text: str | None) -> bool:
    return text is not None and any(map(str.isalpha, text))


def _check_number(languages: int) -> None:
    if languages > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages are labelled: the model would not fit every task")


def fit(labelled: DataFrame, text: str = "text", language: str = "lang") -> tuple[list[str], np.ndarray]:
    """Languages and, per bin, their trigram probabilities.

    Counts are summed on the executors; BINS x languages numbers come back.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, np.ndarray] = {}
        for batch in batches:
            for value, name in zip(batch.column(0), batch.column(1)):
                value = value.as_py()
                if _has_letter(value):
                    own = sums.setdefault(name.as_py(), np.zeros(BINS, np.int64))
                    own += np.bincount(_bins(value), minlength=BINS)
        for name, own in sums.items():
            at = np.flatnonzero(own)
            yield pa.RecordBatch.from_arrays(
                [pa.array([name] * len(at), pa.string()), pa.array(at, pa.int64()), pa.array(own[at], pa.int64())],
                names=["lang", "bin", "n"],
            )

    rows = labelled.where(F.col(language).isNotNull()).select(F.col(text).alias("text"), F.col(language).alias("lang"))
    counted = rows.mapInArrow(count, "lang string, bin long, n long")
    summed = counted.groupBy("lang", "bin").agg(F.sum("n").alias("n"))

    def dense(t: pa.Table) -> pa.Table:
        counts = np.zeros(BINS, "<i8")
        counts[t.column("bin").to_numpy()] = t.column("n").to_numpy()
        return pa.table({"lang": t.column("lang")[:1], "counts": pa.array([counts.tobytes()], pa.binary())})

    each = summed.groupBy("lang").applyInArrow(dense, "lang string, counts binary")
    found = sorted((r["lang"], bytes(r["counts"])) for r in each.limit(MAX_LANGUAGES + 1).collect())
    _check_number(len(found))
    table = np.full((BINS, len(found)), 0.5)
    for k, (_, counts) in enumerate(found):
        table[:, k] += np.frombuffer(counts, "<i8")
    return [name for name, _ in found], table / table.sum(axis=0)


def _mix(counts: np.ndarray, p: np.ndarray) -> tuple[np.ndarray, float]:
    """Proportions by expectation-maximisation, and their log-likelihood."""
    share = np.full(p.shape[1], 1 / p.shape[1])
    total = counts.sum()
    for _ in range(ROUNDS):
        share = share * ((counts / (p @ share)) @ p) / total
    return share, float(counts @ np.log(p @ share))


def proportions(text: str, table: np.ndarray) -> np.ndarray:
    """The share of each language in a text, 0 for those outside the chosen set."""
    every = np.bincount(_bins(text), minlength=BINS)
    at = np.flatnonzero(every)
    counts, p = every[at].astype(float), table[at]
    # trigrams overlap: three of them hold as much as one that does not
    counts /= 3
    share, _ = _mix(counts, p)
    order = np.argsort(-share, kind="stable")
    alone = counts @ np.log(p)
    best = int(np.argmax(alone))
    penalty = 0.5 * np.log(max(counts.sum(), 2.0))
    chosen, worth, result = np.array([best]), alone[best] - penalty, np.array([1.0])
    for k in range(2, 1 + int((share > 0.01).sum())):
        own, likelihood = _mix(counts, p[:, order[:k]])
        if likelihood - k * penalty <= worth:
            break
        chosen, worth, result = order[:k], likelihood - k * penalty, own
    out = np.zeros(table.shape[1])
    out[chosen] = result
    return out


def identify(docs: DataFrame, model: tuple[list[str], np.ndarray], id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: the id, ``lang_pred``, ``score`` (its proportion) and ``mixture`` (language to proportion)."""
    names, table = model
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(table)  # BINS x MAX_LANGUAGES numbers at most

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        p = shared.value
        for batch in batches:
            pred, scores, mixtures = [], [], []
            for value in batch.column(1):
                value = value.as_py()
                if not names or not _has_letter(value):
                    pred.append(UNKNOWN)
                    scores.append(0.0)
                    mixtures.append([])
                    continue
                share = proportions(value, p)
                best = int(np.argmax(share))
                pred.append(names[best])
                scores.append(min(1.0, max(0.0, float(share[best]))))
                mixtures.append([(names[k], float(share[k])) for k in np.flatnonzero(share)])
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array(pred, pa.string()),
                    pa.array(scores, pa.float64()),
                    pa.array(mixtures, pa.map_(pa.string(), pa.float64())),
                ],
                names=["id", "lang_pred", "score", "mixture"],
            )

    rows = docs.select(F.col(id).alias("id"), F.col(text).alias("text"))
    kind = rows.schema["id"].dataType.simpleString()
    out = rows.mapInArrow(score, f"id {kind}, lang_pred string, score double, mixture map<string,double>")
    return out.withColumnRenamed("id", id)


def fit_on_sample(labelled: DataFrame, key: str = "doc_id", fit_rows: int = 20_000) -> tuple[list[str], np.ndarray]:
    """The model of about ``fit_rows`` labelled rows, and of a rare language's rows beyond its share of them.

    Every language has ``fit_rows`` / languages rows of its own where it has as many, or all it has; at most twice
    ``fit_rows`` in sum. Rows are chosen by a hash of key and text, so alike on every run.
    """
    rows = labelled.where(F.col("lang").isNotNull()).select(F.col(key).alias("key"), "text", "lang")
    sizes = {r["lang"]: r["count"] for r in rows.groupBy("lang").count().limit(MAX_LANGUAGES + 1).collect()}
    _check_number(len(sizes))
    total = sum(sizes.values())
    if total <= fit_rows:
        return fit(rows)
    own = fit_rows / len(sizes)
    bounds = {name: round(max(fit_rows / total, min(1.0, own / n)) * (1 << 30)) for name, n in sizes.items()}
    bound = F.create_map(*[F.lit(x) for pair in bounds.items() for x in pair])[F.col("lang")]
    return fit(rows.where(F.pmod(F.xxhash64(F.lit("fit"), "key", "text"), F.lit(1 << 30)) < bound))
