"""Vector codes by product quantisation, whose codebooks are found by ball k-means.

Vectors become integers, floor(``scale`` * x), and are cut into consecutive parts; each
part has a codebook of entries and a vector's code is the index of the nearest entry of
every part (squared Euclidean distance, ties to the lower index). A round assigns all
parts and replaces every entry by the componentwise floor of its parts' mean.

A part is assigned from the entry it had before. The parts of an entry in a block of
rows are a ball around it: its radius is the distance of the farthest of them, and only
entries nearer than twice the radius are its neighbours. An entry without neighbours
keeps its ball as it is. Of other balls the stable core, parts nearer to the entry than
half the way to its nearest neighbour, skips work; the rest lies in annular rings,
whose parts are compared with the neighbours nearer than twice their own distance and with
no other. Distances are whole numbers, so the bounds are exact and never cut a tie.

Work per round: one pass that writes the rows with their codes, one that sums parts per
entry, combined in each task first. The driver holds codebooks and their sums, entries
times length in all. Only the current and the next state are kept in the work folder.

Defined results: rows whose vector is null or holds null or non-finite components are
dropped; entries start as the parts of the smallest ids, a null id sorts last and equal
ids by their vector; with fewer rows than entries the codebook is that much smaller;
repeated rows count each; vectors that are not as long as that of the smallest id keep a
null code and a null error; a length that the parts do not divide gives the first parts one more
component; a null label is a label; an empty table gives no rows; other columns are
ignored. Scaled components beyond 64 bits become the nearest 64-bit number; an error
beyond 64 bits is null. A vector is one row of a task, however long.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from medoria.files import remove
from medoria.llm.common import finite
from medoria.work import work_path

ENTRIES = 256
PARTS = 4
ROUNDS = 4
SCALE = 1024.0
_EXACT = 1 << 53
_WIDE = (1 << 63) - 1
_WIDEST_RING = 64
_AT_ONCE = 1 << 20

STATE = "vec_id {id}, label {label}, v array<long>, codes array<int>, error long"


def cuts(length: int, parts: int) -> list[slice]:
    ends = np.cumsum([0, *(len(x) for x in np.array_split(np.arange(length), parts))])
    return [slice(int(a), int(b)) for a, b in zip(ends, ends[1:])]


def _exact(*arrays: np.ndarray) -> type:
    """The fastest kind of number in which squared distances of these rows are exact."""
    widest = max((max(abs(int(a.min(initial=0))), abs(int(a.max(initial=0)))) for a in arrays), default=0)
    most = arrays[0].shape[1] * (2 * widest) ** 2
    return np.float64 if most < _EXACT else np.int64 if most < _WIDE else object


def distances(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Squared distances of all rows of two arrays of one exact kind."""
    return (x * x).sum(axis=1)[:, None] - 2 * (x @ y.T) + (y * y).sum(axis=1)[None, :]


def _nearest(x: np.ndarray, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    code, best = np.empty(len(x), np.int64), np.empty(len(x), x.dtype)
    step = max(1, _AT_ONCE // max(1, len(entries)))
    for k in range(0, len(x), step):
        d = distances(x[k : k + step], entries)
        # the first of equal distances is the lowest index
        at = np.array([int(np.argmin(row)) for row in d]) if d.dtype == object else d.argmin(axis=1)
        code[k : k + step], best[k : k + step] = at, d[np.arange(len(d)), at]
    return code, best


def assign(x: np.ndarray, entries: np.ndarray, before: np.ndarray | None) -> tuple[np.ndarray, np.ndarray]:
    """(entry, squared distance) of every row; ``before``: the entries of the rows in the last round."""
    kind = _exact(x, entries)
    x, entries = x.astype(kind), entries.astype(kind)
    if before is None:
        return _nearest(x, entries)
    code, own = before.copy(), ((x - entries[before]) ** 2).sum(axis=1)
    gaps = distances(entries, entries)
    order = np.argsort(gaps, axis=1, kind="stable")
    ranked = np.take_along_axis(gaps, order, axis=1)
    radius = np.zeros(len(entries), kind)
    np.maximum.at(radius, before, own)
    # of each ball: the entries within twice its radius, itself among them
    neighbours = (ranked <= 4 * radius[:, None]).sum(axis=1)
    unsettled = np.flatnonzero(neighbours[before] > 1)
    reach = np.zeros(len(x), np.int64)
    step = max(1, _AT_ONCE // len(entries))
    for k in range(0, len(unsettled), step):
        at = unsettled[k : k + step]
        reach[at] = (ranked[before[at]] <= 4 * own[at, None]).sum(axis=1)
    # reach 1 is the stable core: no other entry is within twice the distance. The others by rings
    ring, inner = 2, 1
    while inner < len(entries):
        ring = min(ring, len(entries))
        at = np.flatnonzero((reach > inner) & (reach <= ring))
        if ring > _WIDEST_RING or kind is object:
            at = np.flatnonzero(reach > inner)
            code[at], own[at] = _nearest(x[at], entries)
            break
        step = max(1, _AT_ONCE // (ring * x.shape[1] or 1))
        for k in range(0, len(at), step):
            rows = at[k : k + step]
            some = order[before[rows], :ring]
            d = ((x[rows, None, :] - entries[some]) ** 2).sum(axis=2)
            least = d.min(axis=1)
            code[rows] = np.where(d == least[:, None], some, len(entries)).min(axis=1)
            own[rows] = least
        ring, inner = ring * 2, ring
    return code, own


def _rows(batch: pa.RecordBatch, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Row numbers of the vectors of that length, and these vectors."""
    v = batch.column("v")
    at = np.flatnonzero(pa.compute.list_value_length(v).to_numpy(zero_copy_only=False) == length)
    return at, v.take(pa.array(at)).flatten().to_numpy(zero_copy_only=False).reshape(len(at), length)


def _assigned(state: DataFrame, books: list[np.ndarray], length: int) -> DataFrame:
    kinds = {c: t for c, t in state.dtypes}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at, v = _rows(batch, length)
            given = batch.column("codes").take(pa.array(at))
            known = len(at) and given.null_count == 0
            before = given.flatten().to_numpy(zero_copy_only=False).reshape(len(at), len(books)) if known else None
            found = [
                assign(v[:, cut], book, None if before is None else before[:, k].astype(np.int64))
                for k, (cut, book) in enumerate(zip(cuts(length, len(books)), books))
            ]
            every = np.stack([code for code, _ in found], axis=1).astype(np.int32)
            codes = pa.ListArray.from_arrays(pa.array(np.arange(len(at) + 1, dtype=np.int32) * len(books)), pa.array(every.ravel()))
            total = [sum(map(int, d)) for d in zip(*(d for _, d in found))]
            errors = pa.array([t if t <= _WIDE else None for t in total], pa.int64())
            # null where the length is another
            place = np.full(batch.num_rows, -1)
            place[at] = np.arange(len(at))
            back = pa.array(place, mask=place < 0)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:3], codes.take(back), errors.take(back)], names=["vec_id", "label", "v", "codes", "error"]
            )

    return state.mapInArrow(run, STATE.format(id=kinds["vec_id"], label=kinds["label"]))


def _sums(state: DataFrame, books: list[np.ndarray], length: int) -> dict[tuple[int, int], tuple[int, list[int]]]:
    """(part, entry): how many parts it has and their sums by component."""
    n_entries = len(books[0])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # rows of numbers: part, entry, place (-1: the count), then the sum; one per task
        pieces = cuts(length, len(books))
        counts = np.zeros((len(pieces), n_entries), np.int64)
        sums = [np.zeros((n_entries, p.stop - p.start), object) for p in pieces]
        for batch in batches:
            at, v = _rows(batch, length)
            codes = batch.column("codes").take(pa.array(at)).flatten().to_numpy(zero_copy_only=False)
            for k, piece in enumerate(pieces):
                own = codes.reshape(len(at), len(pieces))[:, k]
                order = np.argsort(own, kind="stable")
                used, first = np.unique(own[order], return_index=True)
                counts[k] += np.bincount(own, minlength=n_entries)
                part = v[order][:, piece]
                if len(used) and part.shape[1]:
                    wide = len(part) * max(abs(int(part.min())), abs(int(part.max()))) > _WIDE
                    sums[k][used] += np.add.reduceat(part.astype(object) if wide else part, first, axis=0).astype(object)
        rows = []
        for k, n in enumerate(counts):
            for e in np.flatnonzero(n).tolist():
                rows.append((k, e, -1, str(n[e])))
                rows += [(k, e, j, str(s)) for j, s in enumerate(sums[k][e])]
        columns = list(zip(*rows)) or [[], [], [], []]
        kinds = [pa.int32(), pa.int32(), pa.int32(), pa.string()]
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(columns, kinds)], names=["part", "entry", "place", "value"]
        )

    some = state.where(F.col("codes").isNotNull()).mapInArrow(run, "part int, entry int, place int, value string")
    summed = some.groupBy("part", "entry", "place").agg(F.sum(F.col("value").cast("decimal(38,0)")).alias("value"))
    found: dict[tuple[int, int], tuple[int, list[int]]] = {}
    for row in summed.orderBy("part", "entry", "place").collect():  # entries x length numbers
        n, parts = found.get((row["part"], row["entry"]), (0, []))
        value = int(row["value"])
        found[row["part"], row["entry"]] = (value, parts) if row["place"] < 0 else (n, [*parts, value])
    return found


def integers(rows: DataFrame, id: str = "vec_id", vector: str = "embedding", label: str = "label", scale: float = SCALE) -> DataFrame:
    """The rows that are kept, as integers and without a code."""
    x = F.transform(F.col(vector).cast("array<double>"), lambda e: F.floor(e * scale))
    return rows.where(finite(F.col(vector))).select(
        F.col(id).alias("vec_id"),
        F.col(label).alias("label"),
        x.cast("array<long>").alias("v"),
        F.lit(None).cast("array<int>").alias("codes"),
        F.lit(None).cast("long").alias("error"),
    )


def books_text(books: list[np.ndarray]) -> str:
    """All components by part, entry and place."""
    return ",".join(str(int(x)) for book in books for entry in book for x in entry)


def encode(
    rows: DataFrame,
    id: str = "vec_id",
    vector: str = "embedding",
    label: str = "label",
    entries: int = ENTRIES,
    parts: int = PARTS,
    rounds: int = ROUNDS,
    scale: float = SCALE,
) -> tuple[DataFrame, list[np.ndarray]]:
    """(vec_id, label, v, codes, error) of the kept rows, and the codebooks, an array of entries per part."""
    spark = rows.sparkSession

    def written(df: DataFrame) -> tuple[DataFrame, str]:
        path = work_path(spark, "vectors")
        df.write.parquet(path)
        return spark.read.schema(df.schema).parquet(path), path

    state, path = written(integers(rows, id, vector, label, scale))
    first = state.orderBy(F.asc_nulls_last("vec_id"), "v").limit(entries).select("v").collect()  # that many at most
    if not first:
        return state, [np.empty((0, 0), np.int64) for _ in range(parts)]
    length = len(first[0]["v"])
    start = np.array([r["v"] for r in first if len(r["v"]) == length], np.int64).reshape(-1, length)
    books = [start[:, cut].copy() for cut in cuts(length, parts)]
    for k in range(rounds + 1):
        last = path
        state, path = written(_assigned(state, books, length))
        remove(spark, last)
        if k == rounds:
            break
        for (part, entry), (n, sums) in _sums(state, books, length).items():
            books[part][entry] = [s // n for s in sums]
    return state, books


def codes(rows: DataFrame, **settings) -> DataFrame:
    """(vec_id, code, error, label_error, codebooks_sha256): codes as two hex digits per part, errors summed per label."""
    state, books = encode(rows, **settings)
    digest = hashlib.sha256(books_text(books).encode()).hexdigest()
    digits = F.array_join(F.transform("codes", lambda c: F.lower(F.lpad(F.hex(c), 2, "0"))), "")
    found = state.select("vec_id", digits.alias("code"), "error", F.col("label").alias("own"))
    # one row per label, however many rows it has
    totals = found.groupBy("own").agg(F.try_sum("error").alias("label_error")).withColumnRenamed("own", "of")
    return found.join(totals, F.col("own").eqNullSafe(F.col("of"))).select(
        "vec_id", "code", "error", "label_error", F.lit(digest).alias("codebooks_sha256")
    )
