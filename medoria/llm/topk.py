"""Exact top-k search by inner product, pruned with segment statistics.

Vectors are cut into 1, 2, 4, ... segments. With the mean m and the deviation s
(the norm of what is left after the mean) of every segment of length l, Cauchy and
Schwarz bound an inner product from above (a distance from below):

    <q, c>  <=  sum over segments of  l * m(q) * m(c) + s(q) * s(c)

The bounds of a level are one small matrix product. A query's k best candidates by
the coarsest bound are scored exactly, which gives a score to beat; candidates
whose bound falls short are dropped level by level, from coarse to fine, and the
survivors get their exact score. A bound never cuts a tie, so results are exact.

Queries and candidates meet in a grid: both sides are dealt into groups of bounded
size, every query group meets every candidate group once, in one task, and each
such meeting hands on at most k rows per query.

Defined results: vectors that are null or hold null or non-finite components take
no part; empty vectors score 0; vectors are compared with vectors of their own
length; rows with the query's own id are not its candidates; repeated query rows
are one query, repeated candidate rows count each; a null id is a candidate that
loses ties, and no query; an empty table gives no rows; other columns are ignored.
Sums beyond 64 bits wrap around.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

LEVELS = (1, 2, 4, 8)
GROUP_QUERIES = 2048
GROUP_VECTORS = 32_768
_TILE = 256
_EXACT = float(1 << 53)


def quantised(rows: DataFrame, id: str = "vec_id", vector: str = "embedding", scale: float = 256.0) -> DataFrame:
    """(id, v): floor(scale * x) of each component as 64-bit numbers, only of vectors whose components are all finite."""
    x = F.col(vector).cast("array<double>")
    finite = F.forall(x, lambda e: e.isNotNull() & ~F.isnan(e) & (F.abs(e) != float("inf")))
    return rows.where(F.col(vector).isNotNull() & finite).select(
        F.col(id).alias("id"), F.transform(x, lambda e: F.floor(e * scale)).cast("array<long>").alias("v")
    )


def statistics(v: np.ndarray, segments: int) -> np.ndarray:
    """Rows whose inner products bound those of the vectors: scaled means and deviations of each segment."""
    parts = np.array_split(np.arange(v.shape[1]), segments)
    out = []
    for at in parts:
        if len(at):
            mean = v[:, at].mean(axis=1)
            out += [mean * np.sqrt(len(at)), np.sqrt(((v[:, at] - mean[:, None]) ** 2).sum(axis=1))]
    return np.stack(out, axis=1)


def _exact(q: np.ndarray, c: np.ndarray) -> np.ndarray:
    if q.shape[1] * float(np.abs(q).max(initial=0)) * float(np.abs(c).max(initial=0)) < _EXACT:
        return (q.astype(np.float64) @ c.astype(np.float64).T).astype(np.int64)
    return q @ c.T


def best(q: np.ndarray, q_ids: np.ndarray, c: np.ndarray, c_ids: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query, candidate, score) of the k best candidates of each query; candidates come sorted by id."""
    found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    if not len(q) or not len(c):
        return (np.empty(0, np.int64),) * 3
    if not q.shape[1]:
        levels = []
    else:
        levels = [s for s in LEVELS if s <= q.shape[1]]
    qf, cf = q.astype(np.float64), c.astype(np.float64)
    c_stats = [statistics(cf, s) for s in levels]
    for begin in range(0, len(q), _TILE):
        rows = slice(begin, begin + _TILE)
        own = q_ids[rows, None] == c_ids[None, :]
        alive = ~own
        if levels and len(c) > k:
            q_stats = [statistics(qf[rows], s) for s in levels]
            bound = np.where(own, -np.inf, q_stats[0] @ c_stats[0].T)
            # the row's own id may take places: k beside them still give a score to beat
            first = np.argpartition(-bound, k - 1, axis=1)[:, :k]
            first_scores = np.einsum("ikd,id->ik", c[first], q[rows])
            first_scores = np.where(np.take_along_axis(own, first, 1), np.iinfo(np.int64).min, first_scores)
            beat = first_scores.min(axis=1).astype(np.float64)
            beat -= 1 + np.abs(beat) * 1e-9
            slack = np.abs(bound[np.isfinite(bound)]).max(initial=0) * 1e-9
            alive &= bound >= beat[:, None] - slack
            for q_own, c_own in zip(q_stats[1:], c_stats[1:]):
                some = alive.any(axis=0)
                cut = q_own @ c_own[some].T >= beat[:, None] - slack
                alive[:, some] &= cut
        some = np.flatnonzero(alive.any(axis=0))
        scores = _exact(q[rows], c[some])
        for i in range(scores.shape[0]):
            at = np.flatnonzero(alive[i, some])
            top = at[np.argsort(-scores[i, at], kind="stable")[:k]]
            found.append((np.full(len(top), begin + i), some[top], scores[i, top]))
    return tuple(np.concatenate(x).astype(np.int64) for x in zip(*found))


def _dense(t: pa.Table) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
    """Vectors of a table by length: the length, row numbers, vectors; sorted by id, null last."""
    t = t.sort_by([("id", "ascending")])
    v = t.column("v").combine_chunks()
    lengths = pa.compute.list_value_length(v).to_numpy(zero_copy_only=False)
    for n in np.unique(lengths):
        at = np.flatnonzero(lengths == n)
        flat = v.take(pa.array(at)).flatten().to_numpy(zero_copy_only=False)
        yield int(n), t.take(pa.array(at)), flat.reshape(len(at), int(n))


def top_k(
    queries: DataFrame, vectors: DataFrame, k: int = 5, group_queries: int = GROUP_QUERIES, group_vectors: int = GROUP_VECTORS
) -> DataFrame:
    """(query_id, rank, vec_id, score) for tables of (id long, v array<long>), as ``quantised`` makes them."""
    queries = queries.where(F.col("id").isNotNull()).distinct()
    n_queries, n_vectors = queries.count(), vectors.count()
    rows, columns = max(1, -(-n_queries // group_queries)), max(1, -(-n_vectors // group_vectors))

    def dealt(n: int, *of: Column) -> Column:
        return F.pmod(F.xxhash64(*of), F.lit(n)).cast("int")

    each = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    left = queries.select("id", "v", F.xxhash64("id", "v").alias("q"), dealt(rows, F.col("id"), F.col("v")).alias("r"), each(columns).alias("c"))
    # which group a row falls into must not depend on the id alone, or its copies meet in one
    right = vectors.select("id", "v", dealt(columns, F.col("id"), F.col("v")).alias("c"), each(rows).alias("r"))

    def meet(q: pa.Table, c: pa.Table) -> pa.Table:
        out: list[pa.Table] = []
        others = {n: (rest, v) for n, rest, v in _dense(c)}
        for n, own, v in _dense(q):
            if n not in others:
                continue
            rest, w = others[n]
            known = rest.column("id").is_valid().to_numpy()
            ids = rest.column("id").fill_null(0).to_numpy()
            i, j, score = best_known(v, own.column("id").to_numpy(), w, ids, known, k)
            out.append(
                pa.table(
                    {
                        "q": own.column("q").take(pa.array(i)),
                        "query_id": own.column("id").take(pa.array(i)),
                        "vec_id": rest.column("id").take(pa.array(j)),
                        "score": pa.array(score),
                    }
                )
            )
        kinds = pa.schema([("q", pa.int64()), ("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.int64())])
        return pa.concat_tables([t.cast(kinds) for t in out]) if out else kinds.empty_table()

    met = (
        left.groupBy("r", "c")
        .cogroup(right.groupBy("r", "c"))
        .applyInArrow(meet, "q long, query_id long, vec_id long, score long")
    )
    order = Window.partitionBy("q", "query_id").orderBy(F.desc("score"), F.asc_nulls_last("vec_id"))
    ranked = met.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")


def best_known(q, q_ids, c, c_ids, known, k):
    """As ``best``, where candidates without an id are nobody's own row."""
    ids = np.where(known, c_ids, np.iinfo(np.int64).min)
    own = np.where(q_ids == np.iinfo(np.int64).min, np.iinfo(np.int64).min + 1, q_ids)
    return best(q, own, c, ids, k)
