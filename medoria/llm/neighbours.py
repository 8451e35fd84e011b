"""Approximate nearest neighbours by inner product: multiprobe p-stable hashing.

A vector x becomes (x, sqrt(M^2 - |x|^2)) with M the largest norm, a query q becomes (q, 0):
then the nearest by distance are the largest by inner product. A table has functions
floor((a * x + b) / w) with normal a (2-stable) and w in units of M; together they name a
cell. The number of functions follows the rows, so that a cell holds about ``OCCUPANCY``.

A query's projections have a distance to every cell, 0 to its own; a neighbour's
projections lie around the query's, so nearer cells are likelier to hold it. Cells are visited
in that order up to a distance ``reach``. It is fitted: of a bounded sample of queries
(``SAMPLE``) the exact neighbours are found in one pass, and ``reach`` is what gets a share
``TARGET`` of them in some table. All rows are indexed and no cell is cut short.

The own cells of a query come first; what they give is the score the other cells have to
beat, so these hand on few rows. Cells of many rows are dealt into blocks of bounded size,
and so are the queries that visit a cell: a task compares one with one and hands on the
best of each query. Candidates of all tables are merged and have their exact score.

Equal vectors are one row first, with the smallest ids, one more than are asked for: no
other can be among the nearest. Equal queries are searched once.

Defined results: vectors that are null, zero or hold null or non-finite components take no
part; a query's own row (its id and its vector) is not its candidate; repeated rows are
one row; a null id is a candidate that loses ties, and no query; vectors are compared with
vectors of their own length; scores add products in a fixed order, so equal vectors tie; an empty
table gives no rows; other columns are ignored. A vector is one value of a task, however long.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from medoria.llm.common import finite
from medoria.work import materialise

TABLES = 2
OCCUPANCY = 8192
WIDTH = 2.0  # of a cell, in units of the largest norm
ENTROPY = 1.3  # bits that a function of that width tells about a vector in no direction of its own
SAMPLE = 64
TARGET = 0.97
BLOCK = 16_384
_TILE = 256
_SLACK = 1e-9


@dataclass(frozen=True)
class Index:
    """The functions of all tables, which are drawn by seed for a length of vectors, and how far queries reach."""

    tables: int
    functions: int
    norm: float
    reach: float
    seed: int = 0

    def projections(self, v: np.ndarray, query: bool) -> list[np.ndarray]:
        """Of each table: the place of every row along every function, in cells."""
        rest = np.zeros(len(v)) if query else np.sqrt(np.maximum(self.norm**2 - (v * v).sum(axis=1), 0))
        out = []
        for t in range(self.tables):
            draw = np.random.default_rng((self.seed, t, v.shape[1]))
            a = draw.normal(size=(v.shape[1] + 1, self.functions))
            b = draw.uniform(size=self.functions)
            out.append((v @ a[:-1] + rest[:, None] * a[-1]) / (WIDTH * self.norm or 1) + b)
        return out


def _mix(codes: np.ndarray, cells: np.ndarray) -> np.ndarray:
    """The name of a cell, one function after the other; two cells with one name are one cell."""
    with np.errstate(over="ignore"):
        x = (codes ^ cells.astype(np.int64).view(np.uint64)) * np.uint64(0x9E3779B97F4A7C15)
        return x ^ (x >> np.uint64(29))


def cells_of(places: np.ndarray, length: int) -> np.ndarray:
    """The cell of every row."""
    codes = np.full(len(places), length, np.uint64)
    for column in np.floor(places).T:
        codes = _mix(codes, column)
    return codes.view(np.int64)


def cells_within(places: np.ndarray, length: int, reach: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, cell, distance): all cells whose squared distance is at most ``reach``, from near to far."""
    row, codes, far = np.arange(len(places)), np.full(len(places), length, np.uint64), np.zeros(len(places))
    steps = np.arange(-math.ceil(math.sqrt(reach)) - 1, math.ceil(math.sqrt(reach)) + 2)
    for place in places.T:
        at = place[row][:, None]
        cell = np.floor(at) + steps
        gap = np.maximum(np.maximum(cell - at, at - cell - 1), 0.0)
        total = far[:, None] + gap * gap
        i, j = np.nonzero(total <= reach)
        row, codes, far = row[i], _mix(codes[i], cell[i, j]), total[i, j]
    order = np.argsort(far, kind="stable")
    return row[order], codes[order].view(np.int64), far[order]


def _by_length(batch: pa.RecordBatch, column: str = "v") -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Vectors by length: the length, row numbers, vectors."""
    v = batch.column(column)
    v = v.combine_chunks() if isinstance(v, pa.ChunkedArray) else v
    lengths = pa.compute.list_value_length(v).to_numpy(zero_copy_only=False)
    for n in np.unique(lengths):
        at = np.flatnonzero(lengths == n)
        flat = v.take(pa.array(at)).flatten().to_numpy(zero_copy_only=False)
        yield int(n), at, flat.reshape(len(at), int(n)).astype(np.float64)


def scores(q: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Inner products of rows with rows; each sum is taken alike wherever its rows stand."""
    return (q * c).sum(axis=1)


def usable(rows: DataFrame, id: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """Distinct (id, v, name) of the rows that take part; ``name`` tells vectors apart."""
    x = F.col(vector)
    some = rows.where(finite(x) & F.coalesce(F.exists(x, lambda e: e != 0), F.lit(False)))
    # adding zero makes one zero of two
    v = F.transform(x, lambda e: e + F.lit(0).cast(rows.schema[vector].dataType.elementType))
    named = some.select(F.col(id).alias("id"), v.alias("v"))
    return named.withColumn("name", F.struct(F.xxhash64("v").alias("a"), F.xxhash64(F.lit("name"), "v").alias("b"))).distinct()


def distinct_vectors(rows: DataFrame, ids: int) -> DataFrame:
    """(name, v, ids): every vector once, with its smallest ids, null last."""
    order = Window.partitionBy("name").orderBy(F.asc_nulls_last("id"))
    few = rows.withColumn("at", F.row_number().over(order)).where(F.col("at") <= ids)
    every = F.array_sort(F.collect_list(F.struct("at", "id")))
    return few.groupBy("name").agg(F.first("v").alias("v"), F.transform(every, lambda s: s["id"]).alias("ids"))


def _exact_sample(vectors: DataFrame, sample: np.ndarray, k: int) -> list[tuple[int, np.ndarray]]:
    """(query, neighbour): the k nearest other vectors of each of a few queries of one length; k rows per task and query."""
    length = sample.shape[1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best_s, best_v = np.empty((len(sample), 0)), np.empty((len(sample), 0, length))
        for batch in batches:
            for n, _, v in _by_length(batch):
                if n != length:
                    continue
                for begin in range(0, len(v), 4096):
                    part = v[begin : begin + 4096]
                    s = sample @ part.T
                    same = (np.abs(sample[:, None, :1] - part[None, :, :1]) == 0)[..., 0]
                    for i, j in zip(*np.nonzero(same)):
                        if (sample[i] == part[j]).all():
                            s[i, j] = -np.inf
                    at = np.argsort(-s, axis=1)[:, :k]
                    best_s = np.concatenate([best_s, np.take_along_axis(s, at, 1)], axis=1)
                    best_v = np.concatenate([best_v, part[at]], axis=1)
                    at = np.argsort(-best_s, axis=1)[:, :k]
                    best_s, best_v = np.take_along_axis(best_s, at, 1), np.take_along_axis(best_v, at[..., None], 1)
        i, j = np.nonzero(np.isfinite(best_s))
        columns = [pa.array(i, pa.int32()), pa.array(best_s[i, j]), pa.array(list(best_v[i, j]), pa.list_(pa.float64()))]
        yield pa.RecordBatch.from_arrays(columns, names=["q", "score", "v"])

    found = vectors.select("v").mapInArrow(run, "q int, score double, v array<double>")
    order = Window.partitionBy("q").orderBy(F.desc("score"), "v")
    best = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return [(r["q"], np.array(r["v"])) for r in best.select("q", "v").collect()]  # k per query of the sample


def fit(vectors: DataFrame, queries: DataFrame, k: int, tables: int = TABLES, sample: int = SAMPLE, target: float = TARGET) -> Index:
    """The index for (name, v): its size by the rows, its reach by a sample of the queries."""
    norm = F.sqrt(F.aggregate(F.transform(F.col("v").cast("array<double>"), lambda e: e * e), F.lit(0.0), lambda a, e: a + e))
    n, most = vectors.agg(F.count("*"), F.max(norm)).first()
    functions = max(0, round(math.log2(max(n, 1) / OCCUPANCY) / ENTROPY))
    index = Index(tables if functions else 1, functions, most or 0.0, 0.0)
    if not functions:
        return index
    some = queries.orderBy(F.xxhash64(F.lit("sample"), "name")).limit(sample).select("v").collect()
    by_length: dict[int, list[list[float]]] = {}
    for row in some:
        by_length.setdefault(len(row["v"]), []).append(row["v"])
    needed: list[float] = []
    for _, rows in sorted(by_length.items()):
        q = np.array(rows, np.float64)
        pairs = _exact_sample(vectors, q, k)
        if not pairs:
            continue
        at, near = np.array([i for i, _ in pairs]), np.stack([v for _, v in pairs])
        gaps = []
        for own, other in zip(index.projections(q, True), index.projections(near, False)):
            own, cell = own[at], np.floor(other)
            gap = np.maximum(np.maximum(cell - own, own - cell - 1), 0.0)
            gaps.append((gap * gap).sum(axis=1))
        needed += np.min(gaps, axis=0).tolist()
    reach = float(np.quantile(needed, target, method="higher")) if needed else 0.0
    return Index(index.tables, functions, index.norm, reach + _SLACK)


def _visit(lookups: DataFrame, vectors: DataFrame, index: Index, k: int, block: int) -> DataFrame:
    """(q, vec_id, score, own): the best of each query in the cells it visits; ``lookups`` has (t, cell, q, floor, qv)."""
    kind = vectors.schema["ids"].dataType.elementType.simpleString()

    def cell_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for n, at, v in _by_length(batch):
                own = batch.take(pa.array(at))
                for t, places in enumerate(index.projections(v, False)):
                    head = [pa.array(np.full(len(at), t, np.int32)), pa.array(cells_of(places, n))]
                    yield pa.RecordBatch.from_arrays([*head, *own.columns], names=["t", "cell", *own.schema.names])

    kinds = {c: d for c, d in vectors.dtypes}
    rows = vectors.select("name", "v", "ids")
    indexed = rows.mapInArrow(cell_rows, f"t int, cell long, name {kinds['name']}, v {kinds['v']}, ids {kinds['ids']}")

    def parts(n: Column) -> Column:
        return F.ceil(n / block).cast("int")

    sizes = indexed.groupBy("t", "cell").agg(parts(F.count("*")).alias("blocks"))
    visits = lookups.groupBy("t", "cell").agg(parts(F.count("*")).alias("groups"))
    grid = materialise(sizes.join(visits, ["t", "cell"]), "grid")

    def dealt(key: str, n: str) -> Column:
        return F.pmod(F.xxhash64(F.lit("deal"), key), F.col(n)).cast("int")

    def every(n: str) -> Column:
        return F.explode(F.sequence(F.lit(0), F.col(n) - 1))

    asked = lookups.join(grid, ["t", "cell"]).withColumn("g", dealt("q", "groups")).withColumn("m", every("blocks"))
    asked = asked.select("t", "cell", "g", "m", "q", "floor", "qv")
    held = indexed.join(grid, ["t", "cell"]).withColumn("m", dealt("name", "blocks")).withColumn("g", every("groups"))
    held = held.select("t", "cell", "g", "m", "name", "v", "ids")

    def meet(a: pa.Table, b: pa.Table) -> pa.Table:
        lengths = {n: (at, c) for n, at, c in _by_length(b)}
        ids = b.column("ids").combine_chunks()
        # by rows of ids: which vector has it, the id, its place among equal scores
        owner = np.repeat(np.arange(len(b)), pa.compute.list_value_length(ids).to_numpy(zero_copy_only=False))
        flat = ids.flatten()
        known = flat.is_valid().to_numpy(zero_copy_only=False)
        value = flat.fill_null(0).to_numpy(zero_copy_only=False)
        first = np.searchsorted(owner, np.arange(len(b) + 1))
        floors = a.column("floor").fill_null(-math.inf).to_numpy()
        names = [tuple(x.values()) for x in b.column("name").to_pylist()]
        asked_names = [tuple(x.values()) for x in a.column("q").to_pylist()]
        out_q, out_id, out_score, out_own = [], [], [], []
        for n, at_q, q in _by_length(a, "qv"):
            if n not in lengths:
                continue
            at_c, c = lengths[n]
            for begin in range(0, len(q), _TILE):
                rough = q[begin : begin + _TILE] @ c.T
                slack = _SLACK * (1 + np.abs(rough).max(initial=0))
                if rough.shape[1] > k:
                    least = -np.partition(-rough, k - 1, axis=1)[:, k - 1]
                else:
                    least = np.full(len(rough), -math.inf)
                least = np.maximum(least, floors[at_q[begin : begin + _TILE]]) - slack
                i, j = np.nonzero(rough >= least[:, None])
                exact = scores(q[begin + i], c[j])
                for row in range(len(rough)):
                    lo, hi = np.searchsorted(i, (row, row + 1))
                    cand, s = at_c[j[lo:hi]], exact[lo:hi]
                    # all ids of these vectors, best first
                    counts = first[cand + 1] - first[cand]
                    places = np.concatenate([np.arange(first[x], first[x + 1]) for x in cand]) if len(cand) else np.empty(0, np.int64)
                    s = np.repeat(s, counts)
                    best = places[np.lexsort((value[places], ~known[places], -s))[:k]]
                    s = np.sort(s)[::-1][: len(best)]
                    asked_at = int(at_q[begin + row])
                    out_q += [asked_at] * len(best)
                    out_id += best.tolist()
                    out_score += s.tolist()
                    out_own += [names[owner[x]] == asked_names[asked_at] for x in best]
        return pa.table(
            {
                "q": a.column("q").take(pa.array(out_q, pa.int64())),
                "vec_id": flat.take(pa.array(out_id, pa.int64())),
                "score": pa.array(out_score, pa.float64()),
                "own": pa.array(out_own, pa.bool_()),
            }
        )

    by = ["t", "cell", "g", "m"]
    met = asked.groupBy(*by).cogroup(held.groupBy(*by))
    return met.applyInArrow(meet, f"q {kinds['name']}, vec_id {kind}, score double, own boolean")


def _best(found: DataFrame, k: int) -> DataFrame:
    """(q, at, vec_id, score, own): the k best rows of each query; what several tables found counts once."""
    order = Window.partitionBy("q").orderBy(F.desc("score"), F.asc_nulls_last("vec_id"), "own")
    ranked = found.distinct().withColumn("at", F.row_number().over(order))
    return ranked.where(F.col("at") <= k).select("q", "at", "vec_id", "score", "own")


def search(
    rows: DataFrame,
    is_query: Column,
    k: int = 20,
    id: str = "vec_id",
    vector: str = "embedding",
    tables: int = TABLES,
    sample: int = SAMPLE,
    target: float = TARGET,
    block: int = BLOCK,
) -> DataFrame:
    """(query_id, rank, vec_id, score): the k nearest rows found of every row that is a query."""
    every = usable(rows, id, vector)
    asking = materialise(usable(rows.where(is_query), id, vector).where(F.col("id").isNotNull()), "queries")
    vectors = materialise(distinct_vectors(every, k + 1), "distinct")
    queries = materialise(asking.groupBy("name").agg(F.first("v").alias("v")), "asked")
    index = fit(vectors, queries, k, tables, sample, target)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for n, at, v in _by_length(batch):
                for t, places in enumerate(index.projections(v, True)):
                    for begin in range(0, len(at), 1024):
                        row, cell, far = cells_within(places[begin : begin + 1024], n, index.reach)
                        own = batch.take(pa.array(at[begin + row]))
                        columns = [pa.array(np.full(len(row), t, np.int32)), pa.array(cell), pa.array(far), *own.columns]
                        yield pa.RecordBatch.from_arrays(columns, names=["t", "cell", "far", "q", "qv"])

    kinds = {c: d for c, d in queries.dtypes}
    lookups = queries.select("name", "v").mapInArrow(run, f"t int, cell long, far double, q {kinds['name']}, qv {kinds['v']}")
    near = lookups.where("far = 0").withColumn("floor", F.lit(None).cast("double"))
    found = materialise(_best(_visit(near, vectors, index, k + 1, block), k + 1), "found")
    if index.functions:
        # fewer than k + 1 found: there is nothing to beat yet
        beat = found.where(F.col("at") == k + 1).select("q", F.col("score").alias("floor"))
        far = lookups.where("far > 0").join(beat, "q", "left")
        found = materialise(_best(found.drop("at").union(_visit(far, vectors, index, k + 1, block)), k + 1), "found")
    lists = found.groupBy("q").agg(F.array_sort(F.collect_list(F.struct("at", "vec_id", "score", "own"))).alias("best"))
    mine = asking.select(F.col("id").alias("query_id"), F.col("name").alias("q"))
    others = F.filter("best", lambda s: ~(s["own"] & s["vec_id"].eqNullSafe(F.col("query_id"))))
    listed = mine.join(lists, "q").select("query_id", F.posexplode(F.slice(others, 1, k)).alias("at", "s"))
    return listed.select("query_id", (F.col("at") + 1).alias("rank"), F.col("s.vec_id").alias("vec_id"), F.col("s.score").alias("score"))
