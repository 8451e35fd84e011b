"""Removal of long repeated strings by blockwise suffix sorting with difference covers.

Every byte covered by a string of LENGTH bytes that also starts anywhere else is
removed. The suffixes of all texts are not sorted at once:

1. *Buckets.* Of the short strings inside a suffix's first LENGTH bytes, the one with
   the smallest hash (the leftmost of equal ones) names the suffix. Equal strings
   have equal names, so a bucket of names holds all suffixes that can be equal.
   Neighbouring suffixes mostly share a name, and such a run travels as one piece
   of text. Equal runs of a task travel once, with the places they stand for.
   Only runs whose name stands in two places travel. Which names do is a bitmap of
   fixed size (SEEN_BITS), which a first pass over the texts fills; names that share a
   bit travel for nothing, and none is lost.
2. *Cover sample.* In a bucket's text the positions of a difference cover modulo V
   are sampled: any two positions i, j have a shift d < V with i + d and j + d both
   sampled. The samples are ranked by their next LENGTH - V + 1 bytes, beforehand.
3. *Ties.* The suffixes of a bucket are sorted by a 64-bit key of their first LENGTH
   bytes. Neighbours with equal keys are a long tie: they are equal if their ranks
   are, d bytes on, and so are the d bytes before and the few after. So a tie costs
   one look-up and V - 1 bytes, and a bucket's memory is bounded.

A bucket holds some whole names. Buckets are the groups of a shuffle, as many as the
bytes of the input ask for, and inside a group one block of BLOCK_BYTES is sorted at a
time. Names that a bounded sample of texts shows to be frequent do not fill a bucket: their
suffixes are dealt by the key itself, each as a pair of 64-bit numbers.

What is removed depends on a text alone, so results are joined back by two 64-bit
hashes of the text, and copies of a text share one answer.

Defined results: a null text is empty and nothing is removed from it; texts shorter
than LENGTH lose nothing; repeated rows are copies of each other, so they lose all
that is in strings of LENGTH bytes; bytes are compared, and a removal may cut through a
character; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from medoria.llm.common import bounded_sample
from medoria.work import materialise

LENGTH = 200
#: length of the short strings, of which a suffix has LENGTH - SHORT + 1
SHORT = 25
#: a difference cover: every number modulo V is a difference of two of these
V = 31
COVER = (1, 5, 11, 24, 25, 27)
UNIT = 1 << 20
BUCKET_BYTES = 16 << 20
BLOCK_BYTES = 1 << 20
SEEN_BITS = 1 << 28
SEEN_PARTS = 256
HOT_SAMPLE = 2000
HOT_SHARE = 0.005

_PLACE = np.uint64(UNIT * 2 - 1)
_BYTE = np.random.default_rng(7).integers(0, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def _join(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Keys of strings from the keys of two that cover them."""
    x = a * np.uint64(0x9E3779B97F4A7C15)
    x ^= x >> np.uint64(29)
    x += b
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(32)
    return x


def grow(key: np.ndarray, have: int, n: int) -> np.ndarray:
    """The key of the n bytes at every position, from that of fewer."""
    while have < n:
        more = min(have, n - have)
        key, have = _join(key[: len(key) - more], key[more:]), have + more
    return key


def keys(text: np.ndarray, n: int) -> np.ndarray:
    return grow(_BYTE[text], 1, n)


def _least(x: np.ndarray, width: int) -> np.ndarray:
    """The minimum of every ``width`` neighbours."""
    n, have = len(x) - width + 1, 1
    while 2 * have <= width:
        x = np.minimum(x[:-have], x[have:])
        have *= 2
    return np.minimum(x[:n], x[width - have : width - have + n])


def runs(text: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(first, last, name) of the runs of suffixes with one name, of texts that end at ``ends``, and the short strings' keys."""
    none = np.empty(0, np.int64)
    if len(text) < LENGTH:
        return (none, none, *[none.astype(np.uint64)] * 2)
    short = keys(text, SHORT)
    packed = (short & ~_PLACE) | np.arange(len(short), dtype=np.uint64)
    anchor = (_least(packed, LENGTH - SHORT + 1) & _PLACE).astype(np.int64)
    begins = np.concatenate([[0], ends[:-1]])
    full = np.zeros(len(anchor) + 1, np.int64)
    long = ends - begins >= LENGTH
    full[begins[long]] += 1
    full[ends[long] - LENGTH + 1] -= 1
    at = np.flatnonzero(np.cumsum(full[:-1]) > 0)
    if not len(at):
        return none, none, none.astype(np.uint64), short
    own = anchor[at]
    new = np.flatnonzero(np.concatenate([[True], (own[1:] != own[:-1]) | (at[1:] != at[:-1] + 1)]))
    last = np.concatenate([new[1:], [len(at)]]) - 1
    return at[new], at[last], short[own[new]], short


def _spread(first: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """first, first + 1, ... of each given size, one after the other."""
    before = np.cumsum(sizes) - sizes
    return np.repeat(first - before, sizes) + np.arange(int(sizes.sum()))


def _equal_bytes(words: np.ndarray, i: np.ndarray, j: np.ndarray, n: int) -> np.ndarray:
    """Whether the n bytes at i and j are equal; ``words`` are the 8 bytes at every position."""
    same = np.ones(len(i), bool)
    for k in [*range(0, n - 7, 8), *([n - 8] if n % 8 else [])]:
        same &= words[i + k] == words[j + k]
    return same


def _words(text: np.ndarray) -> np.ndarray:
    padded = np.concatenate([text, np.zeros(8, np.uint8)])
    return np.ndarray((len(text) + 1,), "<u8", padded, strides=(1,))


_SHIFT = np.full((V, V), V, np.int64)
for _d in range(V - 1, -1, -1):
    for _i in range(V):
        for _j in range(V):
            if (_i + _d) % V in COVER and (_j + _d) % V in COVER:
                _SHIFT[_i, _j] = _d


def cover_ranks(text: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """At the positions of the cover, a rank of the next LENGTH - V + 1 bytes: equal only if these are. Elsewhere -1."""
    n = LENGTH - V + 1
    key = keys(text, n)
    inside = np.repeat(ends, np.diff(np.concatenate([[0], ends])))[: len(key)]
    at = np.flatnonzero(np.isin(np.arange(len(key)) % V, COVER) & (np.arange(len(key)) + n <= inside))
    order = at[np.argsort(key[at], kind="stable")]
    same_key = key[order[1:]] == key[order[:-1]]
    same = same_key.copy()
    tied = np.flatnonzero(same_key)
    same[tied] = _equal_bytes(_words(text), order[tied], order[tied + 1], n)
    rank = np.full(len(text), -1, np.int64)
    rank[order] = np.cumsum(np.concatenate([[0], ~same]))[: len(order)]
    for k in key[order[1:]][same_key & ~same]:
        # different strings with one key: rank them by their bytes
        group = order[key[order] == k]
        strings = {}
        for p in group:
            rank[p] = strings.setdefault(text[p : p + n].tobytes(), int(rank[group].max()) + len(text) + len(strings))
    return rank


def repeated(text: np.ndarray, ends: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Which of the suffixes at ``at`` share their first LENGTH bytes with another one of them."""
    out = np.zeros(len(at), bool)
    if len(at) < 2:
        return out
    key = keys(text, LENGTH)
    order = np.argsort(key[at], kind="stable")
    i, j = at[order[:-1]], at[order[1:]]
    tied = np.flatnonzero(key[i] == key[j])
    if not len(tied):
        return out
    i, j = i[tied], j[tied]
    rank, words = cover_ranks(text, ends), _words(text)
    d = _SHIFT[i % V, j % V]
    same = rank[i + d] == rank[j + d]
    # the d bytes before the sample lie within the first V - 1, those after it within the last V - 1
    near = 8 * -(-(V - 1) // 8)
    same &= _equal_bytes(words, i, j, near) & _equal_bytes(words, i + LENGTH - near, j + LENGTH - near, near)
    out[order[tied[same]]] = True
    out[order[tied[same] + 1]] = True
    return out


SPAN = "k1 long, k2 long, first long, last long"


class Unit:
    """Some pieces of texts in one array: where they end, whose they are and where in their text they begin."""

    def __init__(self, pieces: list[tuple[int, int, int, bytes]]):
        self.text = np.frombuffer(b"".join(p[3] for p in pieces), np.uint8)
        self.ends = np.cumsum([len(p[3]) for p in pieces])
        self.begins = np.concatenate([[0], self.ends[:-1]])
        self.keys = np.array([p[:2] for p in pieces], np.int64).reshape(-1, 2)
        self.offsets = np.array([p[2] for p in pieces], np.int64)


def units(batches: Iterator[pa.RecordBatch]) -> Iterator[Unit]:
    """The texts of batches of (k1, k2, text), at most UNIT bytes at a time."""
    pieces: list[tuple[int, int, int, bytes]] = []
    size = 0
    for batch in batches:
        for k1, k2, value in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2)):
            value = value.as_py()
            # a text longer than a unit comes in pieces that overlap by all but one byte of a string
            for k in range(0, max(1, len(value) - LENGTH + 1), UNIT - LENGTH):
                piece = value[k : k + UNIT - 1]
                if size + len(piece) > UNIT and pieces:
                    yield Unit(pieces)
                    pieces, size = [], 0
                pieces.append((k1, k2, k, piece))
                size += len(piece)
    if pieces:
        yield Unit(pieces)


def _slot(names: np.ndarray) -> np.ndarray:
    """The bit of each name in the bitmap."""
    return (_join(names, names) >> np.uint64(7)) % np.uint64(SEEN_BITS)


def seen_twice(texts: DataFrame) -> np.ndarray:
    """A bitmap in which the bits of all names are set that stand in two places; SEEN_BITS / 8 bytes."""
    width = SEEN_BITS // SEEN_PARTS

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for unit in units(batches):
            names, count = np.unique(runs(unit.text, unit.ends)[2], return_counts=True)
            slot = _slot(names)
            order = np.argsort(slot, kind="stable")
            names, count, part = names[order], count[order], (slot[order] // np.uint64(width)).astype(np.int64)
            cuts = np.searchsorted(part, np.arange(SEEN_PARTS + 1))
            used = np.flatnonzero(np.diff(cuts))
            # a name that stands in two places of the unit is sent twice
            blobs = [np.repeat(names[a:b], np.minimum(count[a:b], 2)).tobytes() for a, b in zip(cuts[used], cuts[used + 1])]
            yield pa.RecordBatch.from_arrays([pa.array(used, pa.int64()), pa.array(blobs, pa.binary())], names=["part", "names"])

    def mark(t: pa.Table) -> pa.Table:
        names = np.sort(np.frombuffer(b"".join(t.column("names").to_pylist()), "<u8"))
        twice = np.unique(names[1:][names[1:] == names[:-1]])
        bits = np.zeros(width, np.uint8)
        bits[(_slot(twice) % np.uint64(width)).astype(np.int64)] = 1
        packed = zstandard.compress(np.packbits(bits).tobytes(), 1)
        return pa.table({"part": t.column("part")[:1], "bits": pa.array([packed], pa.binary())})

    sent = texts.mapInArrow(send, "part long, names binary")
    marked = sent.groupBy("part").applyInArrow(mark, "part long, bits binary").collect()
    out = np.zeros(SEEN_BITS // 8, np.uint8)
    for row in marked:
        begin = row["part"] * width // 8
        out[begin : begin + width // 8] = np.frombuffer(zstandard.decompress(bytes(row["bits"])), np.uint8)
    return out


def _is_set(bits: np.ndarray, names: np.ndarray) -> np.ndarray:
    slot = _slot(names)
    return (bits[(slot >> np.uint64(3)).astype(np.int64)] >> (7 - (slot & np.uint64(7))).astype(np.uint8)) & 1 == 1


def _cut_up(buckets: int, hot: np.ndarray, seen: Callable[[], np.ndarray]):
    """The task function that sends every run of suffixes, whose name ``seen`` holds, to its bucket."""

    def send(text, begins, owner_keys, offsets, first, last, name, key, single) -> Iterator[pa.RecordBatch]:
        dealt = _join(name, key[first]) if single else _join(name, name)
        bucket = (dealt % np.uint64(buckets)).astype(np.int64)
        order = np.lexsort((last - first, key[last], key[first], bucket))
        first, last, name, bucket = first[order], last[order], name[order], bucket[order]
        new = np.ones(len(first), bool)
        new[1:] = (
            (bucket[1:] != bucket[:-1])
            | (key[first[1:]] != key[first[:-1]])
            | (key[last[1:]] != key[last[:-1]])
            | (last[1:] - first[1:] != last[:-1] - first[:-1])
        )
        kind = np.cumsum(new) - 1
        piece = np.searchsorted(begins, first, side="right") - 1
        places = first - begins[piece] + offsets[piece]
        cuts = np.flatnonzero(np.concatenate([[True], bucket[1:] != bucket[:-1], [True]])) if len(bucket) else []
        rows = []
        for a, b in zip(cuts[:-1], cuts[1:]):
            own = np.arange(a, b)[new[a:b]]
            sizes = (last[own] - first[own] + LENGTH).astype("<i8")
            owners = np.concatenate([owner_keys[piece[a:b]], places[a:b, None], kind[a:b, None] - kind[a]], axis=1)
            shared = b"" if single else text[_spread(first[own], sizes)].tobytes()
            rows.append(
                (
                    int(bucket[a]),
                    zstandard.compress(shared, 1),
                    sizes.tobytes(),
                    name[own].tobytes(),
                    key[first[own]].tobytes() if single else b"",
                    zstandard.compress(np.ascontiguousarray(owners.T).astype("<i8").tobytes(), 1),
                    b"1" if single else b"0",
                )
            )
        if rows:
            columns = list(zip(*rows))
            kinds = [pa.int64()] + [pa.binary()] * 6
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, kinds)],
                names=["bucket", "texts", "sizes", "names", "keys", "owners", "single"],
            )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = seen()
        for unit in units(batches):
            first, last, name, short = runs(unit.text, unit.ends)
            twice = _is_set(bits, name)
            first, last, name = first[twice], last[twice], name[twice]
            if not len(first):
                continue
            key = grow(short, SHORT, LENGTH)
            own = (unit.text, unit.begins, unit.keys, unit.offsets)
            is_hot = np.isin(name, hot)
            yield from send(*own, first[~is_hot], last[~is_hot], name[~is_hot], key, False)
            if is_hot.any():
                n = last[is_hot] - first[is_hot] + 1
                each = _spread(first[is_hot], n)
                yield from send(*own, each, each, np.repeat(name[is_hot], n), key, True)

    return run


SENT = "bucket long, texts binary, sizes binary, names binary, keys binary, owners binary, single binary"


def _sort_bucket(t: pa.Table) -> pa.Table:
    """The repeated spans of the suffixes in one bucket."""
    found: list[np.ndarray] = []

    def spans(owner: np.ndarray, marks: np.ndarray, begin: np.ndarray) -> None:
        """Runs of marked suffixes of each owner's piece; the suffixes of piece k are those from begin[k] on."""
        edge = np.zeros(len(marks) + 1, bool)
        edge[begin] = True
        opens = np.flatnonzero(marks & (edge[:-1] | ~np.concatenate([[False], marks[:-1]])))
        closes = np.flatnonzero(marks & (edge[1:] | ~np.concatenate([marks[1:], [False]])))
        of = np.searchsorted(begin, opens, side="right") - 1
        count = np.bincount(of, minlength=len(begin))
        start = np.cumsum(count) - count
        per = count[owner[3]]
        which = np.repeat(np.arange(owner.shape[1]), per)
        run = _spread(start[owner[3]], per)
        base = owner[2][which] - begin[owner[3]][which]
        found.append(np.stack([owner[0][which], owner[1][which], base + opens[run], base + closes[run] + LENGTH - 1]))

    for single in (False, True):
        rows = [r for r in t.to_pylist() if (r["single"] == b"1") == single]
        if not rows:
            continue
        sizes = np.concatenate([np.frombuffer(r["sizes"], "<i8") for r in rows])
        names = np.concatenate([np.frombuffer(r["names"], "<u8") for r in rows])
        owners, before = [], 0
        for r in rows:
            own = np.frombuffer(zstandard.decompress(r["owners"]), "<i8").reshape(4, -1).copy()
            own[3] += before
            before += len(r["names"]) // 8
            owners.append(own)
        owner = np.concatenate(owners, axis=1)
        copies = np.bincount(owner[3], minlength=len(sizes))
        every, back, count = np.unique(names, return_inverse=True, return_counts=True)
        maybe = (count[back] > 1) | (copies > 1)
        if single:
            keys_ = np.concatenate([np.frombuffer(r["keys"], "<u8") for r in rows])
            order = np.lexsort((names, keys_))
            same = (keys_[order[1:]] == keys_[order[:-1]]) & (names[order[1:]] == names[order[:-1]])
            marks = copies > 1
            marks[order[1:][same]] = True
            marks[order[:-1][same]] = True
            spans(owner, marks, np.arange(len(sizes)))
            continue
        if not maybe.any():
            continue
        # only pieces whose name is there twice go on, name by name
        texts = np.concatenate([np.frombuffer(zstandard.decompress(r["texts"]), np.uint8) for r in rows])
        begins = np.cumsum(sizes) - sizes
        kept = np.flatnonzero(maybe)
        kept = kept[np.argsort(names[kept], kind="stable")]
        owner = owner[:, np.argsort(owner[3], kind="stable")]
        owned = np.concatenate([[0], np.cumsum(copies)])
        upto = np.cumsum(sizes[kept])
        borders = np.flatnonzero(names[kept][1:] != names[kept][:-1]) + 1
        begin = 0
        while begin < len(kept):
            base = upto[begin] - sizes[kept[begin]]
            full = np.searchsorted(upto, base + BLOCK_BYTES, side="right")
            # the last border before the block is full, or else the next one
            k = np.searchsorted(borders, full, side="right")
            end = int(borders[k - 1]) if k and borders[k - 1] > begin else int(borders[k]) if k < len(borders) else len(kept)
            if full >= len(kept):
                end = len(kept)
            own = kept[begin:end]
            begin = end
            text = texts[_spread(begins[own], sizes[own])]
            ends = np.cumsum(sizes[own])
            n = sizes[own] - LENGTH + 1
            marks = repeated(text, ends, _spread(ends - sizes[own], n)) | np.repeat(copies[own] > 1, n)
            if marks.any():
                of = owner[:, _spread(owned[own], copies[own])].copy()
                of[3] = np.repeat(np.arange(len(own)), copies[own])
                spans(of, marks, np.cumsum(n) - n)
    out = np.concatenate(found, axis=1) if found else np.empty((4, 0), np.int64)
    # copies of a text have its keys, so their spans are one; spans that meet are one as well
    out = out[:, np.lexsort((-out[3], out[2], out[1], out[0]))]
    if out.shape[1]:
        other = np.any(out[:2, 1:] != out[:2, :-1], axis=0)
        text = np.concatenate([[0], np.cumsum(other)])
        # later texts lie beyond all spans of earlier ones, so one running maximum serves all
        far = text * (int(out[3].max()) + 2)
        reach = np.maximum.accumulate(out[3] + far)
        opens = np.concatenate([[True], out[2, 1:] + far[1:] > reach[:-1] + 1])
        closes = np.concatenate([opens[1:], [True]])
        out = np.stack([out[0, opens], out[1, opens], out[2, opens], (reach - far)[closes]])
    return pa.table({name: pa.array(column) for name, column in zip(("k1", "k2", "first", "last"), out)})


def _hot_names(texts: DataFrame) -> np.ndarray:
    """Names in more than HOT_SHARE of a bounded sample of texts, so no more than LENGTH / HOT_SHARE times a text's few."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for value in batch.column(2):
                seen: set[int] = set()
                value = value.as_py()
                for k in range(0, len(value), UNIT - LENGTH):
                    text = np.frombuffer(value[k : k + UNIT - 1], np.uint8)
                    seen.update(runs(text, np.array([len(text)]))[2].view(np.int64).tolist())
                yield pa.RecordBatch.from_arrays([pa.array(list(seen), pa.int64())], names=["name"])

    sample = bounded_sample(texts, "k1", HOT_SAMPLE)
    n = sample.count()
    counted = sample.mapInArrow(run, "name long").groupBy("name").agg(F.count("*").alias("n"))
    often = counted.where(F.col("n") > max(20, HOT_SHARE * n)).collect()
    return np.array(sorted(r["name"] for r in often), np.int64).view(np.uint64)


def repeated_spans(texts: DataFrame, bucket_bytes: int = BUCKET_BYTES) -> DataFrame:
    """(k1, k2, spans): for a table of (k1, k2, text as bytes), the sorted spans (first, last byte) of repeated strings.

    Spans of one text may touch or overlap. Texts without any have no row.
    """
    total = texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    # a byte is sent about 3.3 times
    buckets = max(1, int(3.3 * total // bucket_bytes))
    seen = texts.sparkSession.sparkContext.broadcast(seen_twice(texts))  # SEEN_BITS, whatever the input
    sent = texts.mapInArrow(_cut_up(buckets, _hot_names(texts), lambda: seen.value), SENT)
    spans = sent.groupBy("bucket").applyInArrow(_sort_bucket, SPAN).distinct()
    return spans.groupBy("k1", "k2").agg(F.sort_array(F.collect_list(F.struct("first", "last"))).alias("spans"))


def remove_repeats(
    docs: DataFrame,
    id: str = "doc_id",
    text: str = "text",
    whole_characters: bool = False,
    bucket_bytes: int = BUCKET_BYTES,
) -> DataFrame:
    """Per row: the id, ``n_bytes``, ``spans`` (first, last byte of each maximal removed run) and ``kept`` (the other bytes).

    With ``whole_characters`` a character goes whole where only some of its bytes would.
    """
    value = F.coalesce(F.col(text), F.lit("")).cast("binary")
    rows = docs.select(F.col(id).alias("id"), value.alias("text")).select(
        "id", F.xxhash64("text").alias("k1"), F.xxhash64(F.lit("again"), "text").alias("k2"), "text"
    )
    found = materialise(repeated_spans(rows.select("k1", "k2", "text"), bucket_bytes), "spans")
    kind = rows.schema["id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        span = pa.list_(pa.struct([("first", pa.int64()), ("last", pa.int64())]))
        for batch in batches:
            sizes, all_spans, kept = [], [], []
            for value, spans in zip(batch.column(1), batch.column(2)):
                value, merged = value.as_py(), []
                for s in spans.as_py() or ():
                    if whole_characters:
                        while s["first"] and value[s["first"]] & 0xC0 == 0x80:
                            s["first"] -= 1
                        while s["last"] + 1 < len(value) and value[s["last"] + 1] & 0xC0 == 0x80:
                            s["last"] += 1
                    if merged and s["first"] <= merged[-1]["last"] + 1:
                        merged[-1]["last"] = max(merged[-1]["last"], s["last"])
                    else:
                        merged.append(dict(s))
                edges = [0, *(x for s in merged for x in (s["first"], s["last"] + 1)), len(value)]
                sizes.append(len(value))
                all_spans.append(merged)
                kept.append(b"".join(value[a:b] for a, b in zip(edges[::2], edges[1::2])))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(sizes, pa.int64()), pa.array(all_spans, span), pa.array(kept, pa.binary())],
                names=["id", "n_bytes", "spans", "kept"],
            )

    joined = rows.join(found, ["k1", "k2"], "left").select("id", "text", "spans")
    out = joined.mapInArrow(run, f"id {kind}, n_bytes long, spans array<struct<first:long,last:long>>, kept binary")
    return out.withColumnRenamed("id", id)
