"""Benchmark decontamination by a distributed positional inverted index.

The index is a written table. A row is a segment: some consecutive documents of one
partition, their ids and word counts, and for every test term (a word of the
benchmark) the places where it stands in the segment, as one sorted posting list.
It is built in one pass over the texts without a shuffle, and it is what phrase and
proximity queries read; the texts are not read again.

A phrase query starts from the rarest term of the phrase, by the lengths of the
posting lists in the segment, subtracts each term's offset in the phrase from its
places, and intersects with the next rarest term until no place or no term is left.
A proximity query does the same, but lets every term stand up to ``slack`` words away
from its place.

The terms of the benchmark are sent to every task. Their size is bounded: items are
dealt into blocks of at most ``block_bytes`` of text, one index per block, and the
blocks' hits are merged per document, so a benchmark of any size gives whole results.

Defined results: a null or wordless text has no words and no hits; a null or
wordless item has no window; repeated documents are judged each; items that share an
id are one item; an item without an id marks words as hit but is not counted; empty
tables give no rows, or rows without hits; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import DataType

from medoria.work import materialise

WINDOW = 10
BLOCK_BYTES = 16 << 20
SEGMENT_BYTES = 4 << 20

# lower-cases A-Z; digits, a-z and everything beyond ASCII belong to words, the rest separates them
_FOLD = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or chr(b).isalnum() else 32 for b in range(256))

INDEX = "segment long, ids array<{kind}>, words array<long>, starts array<long>, terms array<int>, sizes array<int>, places binary"
HITS = "segment long, at int, id {kind}, n_words long, spans array<struct<first:long,last:long>>, items array<{item}>, near array<{item}>"


def words_of(text: bytes) -> list[bytes]:
    return text.translate(_FOLD).split()


def build_index(docs: DataFrame, terms: dict[bytes, int], segment_bytes: int = SEGMENT_BYTES) -> DataFrame:
    """The postings of ``terms`` (word to number) in a table of (id, text as bytes)."""
    shared = docs.sparkSession.sparkContext.broadcast(terms)
    kind = docs.schema["id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = shared.value.get
        segment, size = TaskContext.get().partitionId() << 33, 0
        ids: list = []
        counts: list[int] = []
        found: list[np.ndarray] = []
        id_type = pa.int64()

        def close() -> pa.RecordBatch:
            nonlocal segment, size, ids, counts, found
            # a gap of a window between documents keeps phrases from crossing them
            starts = np.cumsum([0, *(n + 2 * WINDOW for n in counts[:-1])])
            every = np.concatenate(found)
            at = np.concatenate([s + np.arange(n) for s, n in zip(starts, counts)])
            known = np.flatnonzero(every >= 0)
            order = known[np.argsort(every[known], kind="stable")]
            terms_here, sizes = np.unique(every[order], return_counts=True)
            row = [segment, ids, counts, starts.tolist(), terms_here, sizes, at[order].astype("<i4").tobytes()]
            schema = pa.schema(
                [
                    ("segment", pa.int64()),
                    ("ids", pa.list_(id_type)),
                    ("words", pa.list_(pa.int64())),
                    ("starts", pa.list_(pa.int64())),
                    ("terms", pa.list_(pa.int32())),
                    ("sizes", pa.list_(pa.int32())),
                    ("places", pa.binary()),
                ]
            )
            out = pa.RecordBatch.from_arrays([pa.array([x], f.type) for x, f in zip(row, schema)], schema=schema)
            segment, size, ids, counts, found = segment + 1, 0, [], [], []
            return out

        for batch in batches:
            id_type = batch.schema.field(0).type
            for name, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                text = text.as_py()
                numbers = [number(w, -1) for w in words_of(text)]
                ids.append(name)
                counts.append(len(numbers))
                found.append(np.array(numbers, np.int32))
                size += len(text)
                if size >= segment_bytes:
                    yield close()
        if ids:
            yield close()

    return docs.mapInArrow(run, INDEX.format(kind=kind))


def _keep(starts: np.ndarray, other: np.ndarray, slack: int) -> np.ndarray:
    """The starts that the other (sorted) list meets, within ``slack``."""
    if slack:
        return starts[np.searchsorted(other, starts - slack) < np.searchsorted(other, starts + slack, side="right")]
    at = np.searchsorted(other, starts)
    return starts[(at < len(other)) & (other[np.minimum(at, len(other) - 1)] == starts)]


def matches(postings: dict[int, np.ndarray], phrase: list[int], slack: int = 0) -> np.ndarray:
    """The places where a phrase begins, by offset-adjusted lists from the rarest term on.

    With ``slack``, where a phrase could begin so that no term stands farther than that from its place.
    """
    lists = [(len(p), k, p) for k, t in enumerate(phrase) if (p := postings.get(t)) is not None]
    if len(lists) < len(phrase):
        return np.empty(0, np.int64)
    lists.sort(key=lambda x: x[:2])
    starts = lists[0][2] - lists[0][1]
    if slack:
        starts = np.unique((starts[:, None] + np.arange(-slack, slack + 1)).ravel())
    for _, k, p in lists[1:]:
        starts = _keep(starts, p - k, slack)
        if not len(starts):
            break
    return starts


def search(index: DataFrame, windows: list[tuple[object, list[int]]], slack: int, item_kind: DataType) -> DataFrame:
    """One row per document of the index: its spans of hit words and the items that occur in it, exactly or nearly."""
    shared = index.sparkSession.sparkContext.broadcast(windows)
    kind = index.schema["ids"].dataType.elementType.simpleString()

    def spans_of(hit: np.ndarray) -> list[dict]:
        edges = np.flatnonzero(np.diff(np.concatenate([[0], hit, [0]])))
        return [{"first": int(a), "last": int(b) - 1} for a, b in zip(edges[::2], edges[1::2])]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k, row in enumerate(batch.to_pylist()):
                places = np.split(np.frombuffer(row["places"], "<i4").astype(np.int64), np.cumsum(row["sizes"])[:-1])
                postings = dict(zip(row["terms"], places))
                starts = np.array(row["starts"])
                hit: dict[int, np.ndarray] = {}
                items: dict[int, set] = {}
                near: dict[int, set] = {}
                for item, phrase in shared.value:
                    exact = matches(postings, phrase)
                    for at in exact:
                        d = int(np.searchsorted(starts, at, side="right")) - 1
                        marks = hit.setdefault(d, np.zeros(row["words"][d], np.int8))
                        marks[at - starts[d] : at - starts[d] + len(phrase)] = 1
                        items.setdefault(d, set()).add(item)
                    if slack:
                        for at in matches(postings, phrase, slack):
                            near.setdefault(int(np.searchsorted(starts, at + slack, side="right")) - 1, set()).add(item)
                n = len(row["ids"])
                known = lambda found, d: sorted(x for x in found.get(d, ()) if x is not None)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([row["segment"]] * n, pa.int64()),
                        pa.array(range(n), pa.int32()),
                        batch.column(1)[k].values,
                        pa.array(row["words"], pa.int64()),
                        pa.array([spans_of(hit[d]) if d in hit else [] for d in range(n)], SPANS),
                        pa.array([known(items, d) for d in range(n)], pa.list_(item_type)),
                        pa.array([known(near, d) for d in range(n)], pa.list_(item_type)),
                    ],
                    names=["segment", "at", "id", "n_words", "spans", "items", "near"],
                )

    SPANS = pa.list_(pa.struct([("first", pa.int64()), ("last", pa.int64())]))
    item_type = to_arrow_type(item_kind)
    return index.mapInArrow(run, HITS.format(kind=kind, item=item_kind.simpleString()))


def item_windows(text: bytes) -> list[list[bytes]]:
    """All windows of an item: WINDOW consecutive words, or the whole item if it has fewer."""
    found = words_of(text)
    if not found:
        return []
    return [found[k : k + WINDOW] for k in range(max(1, len(found) - WINDOW + 1))]


def contamination(
    docs: DataFrame,
    benchmark: DataFrame,
    id: str = "doc_id",
    text: str = "text",
    item: str = "item_id",
    item_text: str = "text",
    slack: int = 0,
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """Per document: the id, ``n_words``, ``spans`` (first and last hit words), ``items`` and ``near`` (sorted item ids).

    ``items`` occur exactly, ``near`` within ``slack`` (empty without slack).
    """
    rows = docs.select(F.col(id).alias("id"), F.coalesce(F.col(text), F.lit("")).cast("binary").alias("text"))
    tests = benchmark.select(F.col(item).alias("item"), F.coalesce(F.col(item_text), F.lit("")).cast("binary").alias("text"))
    item_kind = tests.schema["item"].dataType
    total = tests.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = int(total // block_bytes) + 1
    if blocks > 1:
        # written once under numbers of their own: every block then sees the same rows, repeated ones told apart
        row = F.struct(F.monotonically_increasing_id().alias("row"), "id")
        rows = materialise(rows.select(row.alias("id"), "text"), "texts")
    found = []
    for block in range(blocks):
        # a block is at most about block_bytes of text, so it may pass through the driver
        own = tests.where(F.pmod(F.xxhash64("item", "text"), F.lit(blocks)) == block).collect()
        terms: dict[bytes, int] = {}
        windows = []
        for name, value in own:
            for window in item_windows(bytes(value)):
                windows.append((name, [terms.setdefault(w, len(terms)) for w in window]))
        index = materialise(build_index(rows, terms), "index")
        found.append(search(index, windows, slack, item_kind))
    if blocks == 1:
        return found[0].drop("segment", "at").withColumnRenamed("id", id)
    return _merged(found).withColumnRenamed("id", id)


def _merged(found: list[DataFrame]) -> DataFrame:
    """The blocks' rows of each document as one, by the number the document was written under."""
    every = found[0]
    for more in found[1:]:
        every = every.unionByName(more)
    united = every.groupBy("id.row").agg(
        F.first("id.id").alias("id"),
        F.first("n_words").alias("n_words"),
        F.sort_array(F.flatten(F.collect_list("spans"))).alias("spans"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("near")))).alias("near"),
    )
    # spans come sorted by their first word; one that begins where another still runs, or right after it, lengthens it
    joined = F.expr(
        """aggregate(spans, cast(array() as array<struct<first:bigint,last:bigint>>), (done, s) ->
             if(size(done) > 0 and s.first <= element_at(done, -1).last + 1,
                concat(slice(done, 1, size(done) - 1),
                       array(named_struct('first', element_at(done, -1).first,
                                          'last', greatest(element_at(done, -1).last, s.last)))),
                concat(done, array(s))))"""
    )
    return united.select("id", "n_words", joined.alias("spans"), "items", "near")
