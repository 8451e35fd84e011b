"""Near-duplicates by SimHash fingerprints and exact tiled comparison.

A fingerprint has 64 bits; a bit is set if it is set in over half the hashes of
a text's word shingles. Fingerprints link if at most ``radius`` bits differ. For
similarities far from 1, where that many bits of 64 also agree by chance, a wide
fingerprint has more words, made of other mixes of the same hashes: it links if at
most ``radius`` bits differ in its first word and ``total`` in all.

Equal fingerprints are one row first, so a group of copies costs one comparison,
however large it is. The distinct ones are laid out in cells by their population
counts (of the whole word, or of its four quarters), and cells in tiles of
bounded size. If two fingerprints differ in at most ``radius`` bits, their
population counts differ by at most that, summed over the parts; so only tiles
of cells that near are compared, and all their pairs are: numpy exclusive-or and
bit counts. A pair of tiles returns a spanning forest of its links, never all
pairs of a group. Components are found over these forests.

Where a similarity of shingle sets decides (``similar_sets``), radii are too large for counts to tell cells
apart. There, fingerprints are compared of sets that share a key: ``candidates``. A key stands for few sets,
those of a key that many share are dealt in tiles, and what is joined already is not compared.

A text of any length has one fingerprint, of all its shingles. Defined results: a null or wordless text has fingerprint zero, which links like
any other; a null id is kept and gets its component's smallest id (null if all
are); repeated rows share their component; an empty table gives no rows; other
columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import product

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from medoria.llm.components import components
from medoria.work import materialise

SEED = 42
TILE = 4096
MEETING = 1 << 15
_AT_ONCE = 1 << 18
_ROWS_AT_ONCE = 1 << 17
_FEW = 64


def shingle_hashes(text: bytes, words: int) -> np.ndarray:
    """XXH64 of all shingles of a text, repeats included; few words are one shingle, none no shingle."""
    from xxhash import xxh64_intdigest

    found = text.lower().split()
    if not found:
        return np.empty(0, np.uint64)
    joined = b" ".join(found)
    if len(found) <= words:
        return np.array([xxh64_intdigest(joined, SEED)], np.uint64)
    ends = np.cumsum([len(w) + 1 for w in found]) - 1
    first = [0, *(ends[:-words] + 1).tolist()]
    last = ends[words - 1 :].tolist()
    return np.fromiter((xxh64_intdigest(joined[a:b], SEED) for a, b in zip(first, last)), np.uint64, len(last))


def simhash(hashes: np.ndarray) -> int:
    """The bits that are set in over half the hashes, as a signed 64-bit number."""
    counts = np.zeros(64, np.int64)
    for k in range(0, len(hashes), 4096):
        part = hashes[k : k + 4096].astype("<u8").view(np.uint8).reshape(-1, 8)
        counts += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * counts > len(hashes), bitorder="little").view("<i8")[0])


def _mixed(hashes: np.ndarray, k: int) -> np.ndarray:
    """Another hash for each hash; the first mix changes nothing."""
    if k == 0:
        return hashes
    x = hashes * np.uint64(0x9E3779B97F4A7C15 + 2 * k)
    return (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)


def fingerprints(docs: DataFrame, words: int = 3, id: str = "doc_id", text: str = "text", wide: int = 1) -> DataFrame:
    """(id, fingerprint) of every row; one pass over the texts. A fingerprint of more than one word is an array."""
    value = pa.int64() if wide == 1 else pa.list_(pa.int64())

    def of(text: bytes):
        hashes = shingle_hashes(text, words)
        found = [simhash(_mixed(hashes, k)) for k in range(wide)]
        return found if wide > 1 else found[0]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = [of(t.as_py()) for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(values, value)], names=["id", "fingerprint"])

    rows = docs.select(F.col(id).alias("id"), F.coalesce(F.col(text), F.lit("")).cast("binary").alias("text"))
    kind = rows.schema["id"].dataType.simpleString()
    out = rows.mapInArrow(run, f"id {kind}, fingerprint {'long' if wide == 1 else 'array<long>'}")
    return out.withColumnRenamed("id", id)


def _cell(fingerprint: Column, parts: int) -> Column:
    """The population counts of the parts, as one number with a byte each."""
    width = 64 // parts
    cell = F.lit(0).cast("long")
    for k in range(parts):
        piece = F.shiftrightunsigned(fingerprint, k * width)
        if width < 64:
            piece = piece.bitwiseAND(F.lit((1 << width) - 1).cast("long"))
        cell = cell + F.bit_count(piece).cast("long") * F.lit(1 << 8 * k).cast("long")
    return cell


def _steps(radius: int, parts: int) -> list[int]:
    """Differences between the numbers of two near cells, of each pair in one direction."""
    near = [d for d in product(range(-radius, radius + 1), repeat=parts) if sum(map(abs, d)) <= radius]
    return sorted({sum(x << 8 * k if x >= 0 else -(-x << 8 * k) for k, x in enumerate(d)) for d in near if d >= (0,) * parts})


def _forest(a: np.ndarray, b: np.ndarray, radius: int, total: int) -> tuple[np.ndarray, np.ndarray]:
    """Stars that join whatever of two arrays is linked; a row is a fingerprint, its columns are the words."""
    every, back = np.unique(np.concatenate([a, b]), axis=0, return_inverse=True)
    back = back.ravel()
    at_a, at_b = back[: len(a)], back[len(a) :]
    label = np.arange(len(every))
    first_a, first_b = a[:, 0].copy(), b[:, 0].copy()
    step = max(1, _AT_ONCE // max(1, len(b)))
    for k in range(0, len(a), step):
        i, j = np.nonzero(np.bitwise_count(first_a[k : k + step, None] ^ first_b[None, :]) <= radius)
        if a.shape[1] > 1:
            differ = np.bitwise_count(a[k + i] ^ b[j]).sum(axis=1, dtype=np.int64)
            i, j = i[differ <= total], j[differ <= total]
        u, v = at_a[k + i], at_b[j]
        u, v = u[u != v], v[u != v]
        while len(u):
            lu, lv = label[u], label[v]
            open_ = lu != lv
            if not open_.any():
                break
            u, v, lu, lv = u[open_], v[open_], lu[open_], lv[open_]
            np.minimum.at(label, np.maximum(lu, lv), np.minimum(lu, lv))
            while (label != label[label]).any():
                label = label[label]
    own = np.flatnonzero(label != np.arange(len(every)))
    return every[own], every[label[own]]


def _tile_pairs(distinct: DataFrame, radius: int, parts: int, tile: int) -> DataFrame:
    """(a, b, same): the fingerprints of any two tiles of near cells; ``same``: a and b are one tile."""
    kind = distinct.schema["fingerprint"].dataType.simpleString()
    first = F.col("fingerprint") if kind == "bigint" else F.col("fingerprint")[0]
    cells = distinct.select("fingerprint", _cell(first, parts).alias("cell"))
    sizes = cells.groupBy("cell").agg(F.ceil(F.count("*") / tile).alias("tiles"))
    tiles = (
        cells.join(sizes, "cell")
        .withColumn("tile", F.pmod(F.xxhash64("fingerprint"), F.col("tiles")))
        .groupBy("cell", "tile")
        .agg(F.collect_list("fingerprint").alias("prints"))
    )
    tiles = materialise(tiles, "tiles")
    steps = F.array(*(F.lit(s).cast("long") for s in _steps(radius, parts)))
    left = tiles.select(
        F.col("cell").alias("own"), F.col("tile").alias("left"), F.col("prints").alias("a"), F.explode(steps).alias("step")
    ).withColumn("cell", F.col("own") + F.col("step"))
    pairs = left.join(tiles, "cell").where("step <> 0 or left <= tile")
    return pairs.select("a", F.col("prints").alias("b"), F.expr("step = 0 and left = tile").alias("same"))


def links(distinct: DataFrame, radius: int, parts: int, total: int | None = None, tile: int = TILE) -> DataFrame:
    """Edges (u, v) that connect whatever fingerprints are connected by links.

    ``distinct`` has one row per fingerprint, in a column of that name.
    """
    kind = distinct.schema["fingerprint"].dataType.simpleString()
    pairs = _tile_pairs(distinct, radius, parts, tile).select("a", "b")
    bound = radius if total is None else total

    def rows(prints: pa.Scalar) -> np.ndarray:
        values = prints.values
        if kind == "bigint":
            return values.to_numpy().view(np.uint64).reshape(-1, 1)
        return values.flatten().to_numpy().view(np.uint64).reshape(len(values), -1)

    def column(prints: np.ndarray) -> pa.Array:
        signed = prints.view(np.int64)
        return pa.array(signed[:, 0]) if kind == "bigint" else pa.array(signed.tolist(), pa.list_(pa.int64()))

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b in zip(batch.column(0), batch.column(1)):
                u, v = _forest(rows(a), rows(b), radius, bound)
                if len(u):
                    yield pa.RecordBatch.from_arrays([column(u), column(v)], names=["u", "v"])

    return pairs.mapInArrow(compare, f"u {kind}, v {kind}")


def near_duplicates(
    docs: DataFrame,
    words: int = 3,
    radius: int = 2,
    id: str = "doc_id",
    text: str = "text",
    parts: int = 4,
    wide: int = 1,
    total: int | None = None,
) -> DataFrame:
    """One row per document: the id, ``fingerprint`` (signed words of 64 bits) and ``component_id``, the smallest id reachable.

    ``parts`` population counts tell cells apart: 4 for a small radius, 1 for a large one.
    """
    prints = materialise(fingerprints(docs, words, id, text, wide), "fingerprints")
    distinct = prints.groupBy("fingerprint").agg(F.min(id).alias("least"))
    roots = components(links(distinct.select("fingerprint"), radius, parts, total))
    rooted = distinct.join(roots, distinct["fingerprint"] == roots["node"], "left").select(
        "fingerprint", "least", F.coalesce("root", "fingerprint").alias("root")
    )
    rooted = materialise(rooted, "rooted")
    least = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    named = rooted.join(least, "root").select("fingerprint", "component_id")
    return prints.join(named, "fingerprint").select(id, "fingerprint", "component_id")


# a shingle set as a row of numbers: words of its fingerprint, its size, a number that stands for it
SET_WORDS = 4
NODE = SET_WORDS + 2


def set_row(hashes: np.ndarray, number: int) -> list[int]:
    """The row of numbers of a set of shingle hashes."""
    return [*(simhash(_mixed(hashes, k)) for k in range(SET_WORDS)), len(hashes), number]


def _within(x: np.ndarray, i: np.ndarray, y: np.ndarray, j: np.ndarray, radius: int, total: int, similar: tuple[int, int]) -> tuple[np.ndarray, np.ndarray]:
    """Which of the pairs of rows i of x and j of y may be similar, and in how many bits these differ."""
    # sets whose sizes are too far apart cannot be similar
    size_i, size_j = x[i, SET_WORDS].astype(np.int64), y[j, SET_WORDS].astype(np.int64)
    at = np.flatnonzero(np.minimum(size_i, size_j) * similar[1] >= np.maximum(size_i, size_j) * similar[0])
    bits = np.bitwise_count(x[i[at], :SET_WORDS] ^ y[j[at], :SET_WORDS])
    differ = bits.sum(axis=1, dtype=np.int64)
    near = (bits[:, 0] <= radius) & (differ <= total)
    return at[near], differ[near]


def _near(
    a: np.ndarray, b: np.ndarray, same: bool, radius: int, total: int, similar: tuple[int, int]
) -> tuple[np.ndarray, np.ndarray]:
    """Numbers of pairs of two arrays that join whatever may be similar, the nearest first."""
    _, back = np.unique(np.concatenate([a[:, -1], b[:, -1]]), return_inverse=True)
    of_a, of_b = back[: len(a)], back[len(a) :]
    label = np.arange(len(a) + len(b))
    first_a, first_b = a[:, 0].copy(), b[:, 0].copy()
    found_a, found_b = [], []
    step = max(1, _AT_ONCE // max(1, len(b)))
    rest, every = np.arange(len(a)), np.arange(len(b))
    while len(rest):
        own, rest = rest[:step], rest[step:]
        mine = label[of_a[own]]
        other = every
        if (mine == mine[0]).all():
            # what is joined needs no other pair
            other = np.flatnonzero(label[of_b] != mine[0])
            if not len(other):
                rest = rest[label[of_a[rest]] != mine[0]]
                continue
        i, j = np.nonzero(np.bitwise_count(first_a[own][:, None] ^ first_b[other][None, :]) <= radius)
        i, j = own[i], other[j]
        open_ = label[of_a[i]] != label[of_b[j]]
        if same:
            open_ &= i < j
        i, j = i[open_], j[open_]
        near, differ = _within(a, i, b, j, radius, total, similar)
        order = near[np.argsort(differ, kind="stable")]
        i, j = i[order], j[order]
        joins = len(i) > 0
        while len(i):
            u, v = label[of_a[i]], label[of_b[j]]
            open_ = u != v
            i, j, u, v = i[open_], j[open_], u[open_], v[open_]
            # each group takes its nearest pair with a group of a smaller number, so there is no circle
            group, at = np.unique(np.maximum(u, v), return_index=True)
            found_a.append(i[at])
            found_b.append(j[at])
            label[group] = np.minimum(u, v)[at]
            while (label != label[label]).any():
                label = label[label]
        if joins:
            rest = rest[np.argsort(label[of_a[rest]], kind="stable")]
    i, j = (np.concatenate([*x, np.empty(0, np.int64)]).astype(np.int64) for x in (found_a, found_b))
    return a[i, -1], b[j, -1]


def _near_in_few(x: np.ndarray, sizes: np.ndarray, radius: int, total: int, similar: tuple[int, int]) -> tuple[np.ndarray, np.ndarray]:
    """The same within each of many small groups of rows that follow each other; a pair or two more than needed."""
    to_end = np.repeat(np.cumsum(sizes), sizes) - np.arange(len(x))
    label = np.arange(len(x))
    found_i, found_j = [], []
    for apart in range(1, int(sizes.max(initial=1))):
        i = np.flatnonzero(to_end > apart)
        i = i[label[i] != label[i + apart]]
        i = i[_within(x, i, x, i + apart, radius, total, similar)[0]]
        if len(i):
            found_i.append(i)
            found_j.append(i + apart)
            u, v = label[i], label[i + apart]
            np.minimum.at(label, np.maximum(u, v), np.minimum(u, v))
            while (label != label[label]).any():
                label = label[label]
    i, j = (np.concatenate([*y, np.empty(0, np.int64)]).astype(np.int64) for y in (found_i, found_j))
    return x[i, -1], x[j, -1]


def _gathered(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.Table, bool]]:
    """Batches put together, and whether they are the last."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if sum(map(len, held)) >= _ROWS_AT_ONCE:
            yield pa.Table.from_batches(held), False
            held = []
        held.append(batch)
    if held:
        yield pa.Table.from_batches(held), True


def _opens(*columns: np.ndarray) -> np.ndarray:
    """Where rows differ from those before them."""
    new = np.ones(len(columns[0]), bool)
    new[1:] = np.logical_or.reduce([c[1:] != c[:-1] for c in columns])
    return new


def _met(postings: DataFrame, most: int) -> DataFrame:
    """(meeting, tile, point): the sets that share a key; keys of one and the same sets are one meeting.

    A key of more than ``most`` sets has them in tiles. Rows of a key are never held together.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, point = np.empty(0, np.int64), np.empty(0, np.int64)
        # a key whose first tiles are out, and how many these are
        opened, out = None, 0
        for batch, last in _gathered(batches):
            key, point = (np.concatenate([x, c.to_numpy()]) for x, c in zip((key, point), batch.columns))
            if not len(key):
                continue
            order = np.lexsort((point, key))
            key, point = key[order], point[order]
            new = _opens(key, point)
            key, point = key[new], point[new]
            starts = np.flatnonzero(_opens(key))
            sizes = np.diff(np.r_[starts, len(key)])
            nth = np.arange(len(starts))
            whole = nth < len(starts) - (not last)
            further = (nth == 0) & (opened is not None and key[0] == opened)
            plain = whole & (sizes > 1) & (sizes <= most) & ~further
            # the sum of the members' hashes is the name; if two are equal by chance, sets meet for nothing
            names = _mixed(np.add.reduceat(_mixed(point.view(np.uint64), 1), starts) + sizes.astype(np.uint64), 2)
            use = np.repeat(plain, sizes)
            found = [(np.repeat(names[plain], sizes[plain]), np.zeros(int(use.sum()), np.int32), point[use])]
            opened, left = None, len(key) if last else starts[-1]
            for k in np.flatnonzero(further | (sizes > most)).tolist():
                out = out if further[k] else 0
                first, end = starts[k], starts[k] + sizes[k]
                name = _mixed(key[first : first + 1].view(np.uint64), 3)
                while end - first > (0 if whole[k] else most):
                    part = point[first : min(first + most, end)]
                    found.append((np.repeat(name, len(part)), np.full(len(part), out, np.int32), part))
                    first, out = first + len(part), out + 1
                if not whole[k]:
                    opened, left = key[first], first
            key, point = key[left:], point[left:]
            meeting, tile, member = (np.concatenate(x) for x in zip(*found))
            if len(member):
                columns = [pa.array(meeting.view(np.int64)), pa.array(tile), pa.array(member)]
                yield pa.RecordBatch.from_arrays(columns, names=["meeting", "tile", "point"])

    dealt = postings.select("key", "point").repartition("key").sortWithinPartitions("key")  # one number: a radix sort
    return dealt.mapInArrow(run, "meeting long, tile int, point long").distinct()


def candidates(
    postings: DataFrame, distinct: DataFrame, radius: int, total: int, similar: tuple[int, int], most: int = MEETING
) -> DataFrame:
    """Pairs (u, v) that join whatever sets may be similar; ``distinct`` has a row of numbers for each.

    ``postings`` has (key, point); similar sets have a key in common, ``point`` is the last of a set's numbers.
    A row of numbers: the words of its fingerprint, its size, a number of its own. Sets with a common key are candidates
    if at most ``radius`` bits differ in the first word, ``total`` in all, and their sizes allow the similarity.
    """
    met = materialise(_met(postings, most), "met")
    tiles = met.where("tile > 0").groupBy("meeting").agg(F.max("tile").alias("last"))
    rows = met.join(distinct.select("point", "fingerprint"), "point").join(tiles, "meeting", "left")
    rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0), F.coalesce("last", F.lit(0)))))
    rows = rows.select(
        "meeting", F.least("tile", "other").alias("a"), F.greatest("tile", "other").alias("b"), (F.col("tile") > F.col("other")).alias("side"), "fingerprint"
    )
    rows = rows.repartition("meeting", "a", "b").sortWithinPartitions("meeting", "a", "b", "side")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: pa.Table | None = None
        for batch, last in _gathered(batches):
            t = (batch if held is None else pa.concat_tables([held, batch])).combine_chunks()
            starts = np.flatnonzero(_opens(*(t.column(c).to_numpy() for c in ("meeting", "a", "b"))))
            end = len(t) if last else int(starts[-1])
            held, t, starts = t.slice(end), t.slice(0, end), starts[starts < end]
            if not end:
                continue
            sizes = np.diff(np.r_[starts, end])
            x = t.column("fingerprint").combine_chunks().flatten().to_numpy().view(np.uint64).reshape(end, NODE)
            split = np.add.reduceat((~t.column("side").to_numpy()).astype(np.int64), starts)
            few = (sizes <= _FEW) & (split == sizes)
            found = [_near_in_few(x[np.repeat(few, sizes)], sizes[few], radius, total, similar)]
            for k in np.flatnonzero(~few).tolist():
                own, cut = x[starts[k] : starts[k] + sizes[k]], split[k]
                a, b = (own, own) if cut == len(own) else (own[:cut], own[cut:])
                found.append(_near(a, b, cut == len(own), radius, total, similar))
            u, v = (np.concatenate(y).view(np.int64) for y in zip(*found))
            if len(u):
                yield pa.RecordBatch.from_arrays([pa.array(np.minimum(u, v)), pa.array(np.maximum(u, v))], names=["u", "v"])

    return rows.mapInArrow(run, "u long, v long").distinct()
