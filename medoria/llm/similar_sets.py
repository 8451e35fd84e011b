"""Near-duplicates by the similarity of their shingle sets: fingerprints compared in tiles, exactly.

SimHash bits of two similar sets agree only with some probability, so a bound on them
loses links. A parity fingerprint does not: each shingle flips one of its bits, so two
fingerprints differ in at most as many bits as the sets differ in shingles. Sets of
similarity num / den and sizes a and b differ in at most (a + b) (den - num) / (den + num)
shingles; what differs in more bits is no link. What is left is decided by the bit rows of the
sets themselves. Both are numpy exclusive-or, and, and bit counts over tiles of bounded size.

Which sets meet in a tile is exact, too. Sizes are cut into bands, so that the sizes of
similar sets lie in one band or in two that follow each other. The shingles of a set are dealt over
the parts of a band by their hash; a band has more parts than similar sets of it may differ in
shingles, so some part is equal in both. The hash of a part is a key. An empty part is no key:
a set with so many empty parts that these alone might be the equal ones adds its
smallest shingles, so many that similar sets share one of them. Sets joined by keys are a
cluster; similar sets are in one cluster. Key equality of a part means several shingles
in common, wherever they stand, so a line that many texts share makes no key.

With ``radius`` the clusters are those of SimHash candidates instead. The keys are then single shingles: the first
of a set in an order of all shingles, a fifth of it and one more, so that similar sets have one of them in
common, whatever the order. Frequent shingles stand last in it, so few sets that are not similar meet.

Small clusters share a task. A large one is laid out in cells by band and these in tiles;
tiles of one band or of two that follow each other are compared, others differ too much in
their bit counts. A task returns a forest of verified links, never all pairs, so near
copies, and near texts that are not similar enough, hand on no more rows than there are sets.

Equal sets are one row first. A key that stands in many texts of a slice of the rows leaves it
once. So no group is larger than a tile, or the number of slices of ``SLICE_BYTES``.

Defined results: a null or wordless text has the empty set; all of these are equal; texts
of fewer words than a shingle have one shingle, of all words; a text of any length is one set,
of all its shingles; a null id is kept; equal ids must have equal texts; repeated rows share
their component; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from medoria.files import remove
from medoria.llm.common import bounded_sample
from medoria.llm.components import components
from medoria.llm.simhash import candidates, set_row
from medoria.work import materialise, work_path

TILE_SHINGLES = 1 << 18
TILE_ROWS = 2048
SLICE_BYTES = 1 << 21  # of text that a task turns into sets at once, or one text
_SKETCH = 4096
_AT_ONCE = 1 << 20
_WORDS_KNOWN = 1 << 18
ORDER_TEXTS = 1 << 13  # texts whose shingles are counted for the order of shingles
ORDER_SHINGLES = 1 << 18
_A, _B = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93)


class _WordHashes(dict):
    def __missing__(self, word: bytes) -> int:
        from xxhash import xxh64_intdigest

        if len(self) > _WORDS_KNOWN:
            self.clear()
        found = self[word] = xxh64_intdigest(word)
        return found


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * _A
    return (x ^ (x >> np.uint64(29))) * _B


def shingle_set(text: bytes, words: int, known: dict[bytes, int]) -> np.ndarray:
    """The sorted distinct hashes of a text's shingles; few words are one shingle, none no shingle."""
    found = text.lower().split()
    if not found:
        return np.empty(0, np.uint64)
    h = np.fromiter(map(known.__getitem__, found), np.uint64, len(found))
    n = max(1, len(h) - words + 1)
    x = h[:n].copy()
    for k in range(1, min(words, len(h))):
        x = _mix(x) + h[k : k + n]
    return np.unique(_mix(x))


class Bands:
    """Sizes of sets, and into how many parts sets of a band are dealt."""

    def __init__(self, similar: tuple[int, int]):
        self.similar = num, den = similar
        # smaller sets are similar to equal ones alone
        starts = [-(-num // (den - num))]
        while starts[-1] < 1 << 40:
            starts.append(starts[-1] * den // num + 1)
        self.starts = np.array(starts)
        largest = self.starts[1:] - 1
        self.differ = 2 * largest * (den - num) // (den + num)
        self.slack = np.maximum(1, self.differ // 10)
        self.parts = self.differ + 1 + self.slack

    def of(self, sizes: np.ndarray) -> np.ndarray:
        """The band of each size; -1 below the first."""
        return np.searchsorted(self.starts, sizes, side="right") - 1

    def keys(self, flat: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(set, key) of sets whose sorted hashes follow each other in ``flat``."""
        num, den = self.similar
        rows, keys = [], []
        # a set meets sets of its own band, and larger ones of the next
        for up in (0, 1):
            band = self.of(sizes)
            use = np.flatnonzero(band >= 0)
            if not len(use):
                continue
            band = band[use] + up
            n, parts = sizes[use], self.parts[band]
            inside = np.repeat(self.of(sizes) >= 0, sizes)
            h = flat[inside]
            owner = np.repeat(np.arange(len(use)), n)
            first = np.cumsum(parts) - parts
            slot = first[owner] + ((h >> np.uint64(20)) % parts[owner].astype(np.uint64)).astype(np.int64)
            sums = np.zeros(int(parts.sum()), np.uint64)
            np.add.at(sums, slot, _mix(h ^ _B))
            filled = np.bincount(slot, minlength=len(sums)) > 0
            own = np.repeat(np.arange(len(use)), parts)
            place = (np.arange(len(sums)) - first[own]).astype(np.uint64)
            tag = (band[own].astype(np.uint64) << np.uint64(40)) + place
            rows.append(use[own[filled]])
            keys.append(_mix(sums ^ _mix(tag))[filled])
            # enough empty parts to be all that is equal
            empty = parts - np.bincount(own[filled], minlength=len(use))
            special = np.flatnonzero(empty > self.slack[band])
            begins = np.cumsum(n) - n
            for k in special.tolist():
                prefix = h[begins[k] : begins[k] + n[k] - -(-n[k] * num // den) + 1]
                rows.append(np.full(len(prefix), use[k]))
                keys.append(_mix(prefix + _mix(np.full(1, band[k] + 1, np.uint64))))
        return tuple(np.concatenate([*x, np.empty(0, kind)]).astype(kind) for x, kind in ((rows, np.int64), (keys, np.uint64)))


class Order:
    """An order of all shingles: those of ``often`` come last, as they stand there, the others by their hash.

    Any order finds all similar sets; with frequent shingles last few sets meet.
    """

    def __init__(self, often: np.ndarray):
        by_hash = np.argsort(often)
        self.often, self.rank = often[by_hash], by_hash
        self.maybe = np.zeros(1 << 20, bool)
        self.maybe[(often >> np.uint64(44)).astype(np.int64)] = True

    def ranks(self, flat: np.ndarray) -> np.ndarray:
        """The place of each hash in ``often``; -1 of the others."""
        out = np.full(len(flat), -1)
        some = np.flatnonzero(self.maybe[(flat >> np.uint64(44)).astype(np.int64)])
        at = np.minimum(np.searchsorted(self.often, flat[some]), len(self.often) - 1)
        known = self.often[at] == flat[some] if len(some) else np.empty(0, bool)
        out[some[known]] = self.rank[at[known]]
        return out

    def firsts(self, flat: np.ndarray, sizes: np.ndarray, similar: tuple[int, int]) -> tuple[np.ndarray, np.ndarray]:
        """(set, shingle): the first shingles of each set, so many that similar sets have one of them in common.

        The sets' sorted hashes follow each other in ``flat``. Similar sets have num / den of the larger in
        common; what one has before the first of these is not in the other, so it is at most the rest.
        """
        num, den = similar
        take = np.minimum(sizes, sizes - -(-sizes * num // den) + 1)
        owner = np.repeat(np.arange(len(sizes)), sizes)
        rank = self.ranks(flat)
        rare = rank < 0
        before = np.r_[0, np.cumsum(rare)]
        begins = np.cumsum(sizes) - sizes
        place = before[:-1] - before[begins[owner]]
        chosen = rare & (place < take[owner])
        lacking = take - (before[begins + sizes] - before[begins])
        others = np.flatnonzero(~rare & (lacking[owner] > 0))
        others = others[np.lexsort((rank[others], owner[others]))]
        own = owner[others]
        nth = np.arange(len(own)) - np.searchsorted(own, own)
        chosen[others[nth < lacking[own]]] = True
        return owner[chosen], flat[chosen]


def _often(rows: DataFrame, words: int) -> np.ndarray:
    """The shingles that stand in two or more of a bounded number of texts, the rarest of them first."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = _WordHashes()
        for batch in (piece for batch in batches for piece in _slices(batch, 0)):
            sets = [shingle_set(t.as_py(), words, known) for t in batch.column(0)]
            found, n = np.unique(np.concatenate([*sets, np.empty(0, np.uint64)]), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(found.view(np.int64)), pa.array(n)], names=["shingle", "n"])

    texts = bounded_sample(rows.select("text"), "text", ORDER_TEXTS)
    counted = texts.mapInArrow(run, "shingle long, n long").groupBy("shingle").agg(F.sum("n").alias("n")).where("n > 1")
    counted = materialise(counted, "often")
    least, so_far = 2, 0
    for n, shingles in sorted(counted.groupBy("n").count().collect(), reverse=True):
        so_far += shingles
        if so_far > ORDER_SHINGLES:
            least = n + 1
            break
    found = counted.where(F.col("n") >= least).orderBy("n", "shingle").select("shingle").toArrow()
    return found.column(0).to_numpy().view(np.uint64)


def _slices(batch: pa.RecordBatch, column: int) -> Iterator[pa.RecordBatch]:
    """A batch in pieces of bounded text, each row whole."""
    sizes = pa.compute.binary_length(batch.column(column)).to_numpy(zero_copy_only=False)
    piece = np.cumsum(sizes + 1) // SLICE_BYTES
    ends = np.r_[np.flatnonzero(np.diff(piece)) + 1, len(piece)]
    first = 0
    for end in ends.tolist():
        if end > first:
            yield batch.slice(first, end - first)
        first = end


def _joined(row: np.ndarray, key: np.ndarray, points: np.ndarray) -> np.ndarray:
    """Of each row the first row of its group: rows with one key or one point are in one group."""
    label = np.arange(len(points))
    every = np.arange(len(points))
    _, by_key = np.unique(key, return_inverse=True)
    _, by_point = np.unique(points, return_inverse=True)
    row, group = np.concatenate([row, every]), np.concatenate([by_key + len(points), by_point])
    while True:
        least = np.full(len(points) + len(key), len(points))
        np.minimum.at(least, group, label[row])
        new = label.copy()
        np.minimum.at(new, row, least[group])
        # the label of a row's label is a row of its group, too
        np.minimum.at(new, label, new.copy())
        new = new[new]
        if (new == label).all():
            return label
        label = new


def _named_sets(batches: Iterator[pa.RecordBatch], words: int) -> Iterator[tuple[pa.RecordBatch, list[np.ndarray], list[bytes], np.ndarray]]:
    """Slices of (id, text) with the set of every text, its name, and a number that stands for it in the graph of keys."""
    from xxhash import xxh3_128_digest

    known = _WordHashes()
    for batch in (piece for batch in batches for piece in _slices(batch, 1)):
        sets = [shingle_set(t.as_py(), words, known) for t in batch.column(1)]
        names = [xxh3_128_digest(s.astype("<u8").tobytes()) for s in sets]
        points = np.array([int.from_bytes(x[:8], "little") for x in names], np.uint64).view(np.int64)
        yield batch, sets, names, points


def _sets(docs: DataFrame, words: int, similar: tuple[int, int], often: np.ndarray | None) -> DataFrame:
    """(id, node, point, fingerprint, keys) of every row of (id, text): ``node`` names the set.

    Only if frequent shingles are given there are a fingerprint and keys: shingles one of which similar sets share.
    """
    shared = docs.sparkSession.sparkContext.broadcast(often)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        many = pa.list_(pa.int64())
        order = None if shared.value is None else Order(shared.value)
        for batch, sets, names, points in _named_sets(batches, words):
            rows, keys = pa.nulls(len(sets), many), pa.nulls(len(sets), many)
            if order is not None:
                rows = pa.array([set_row(s, int(p)) for s, p in zip(sets, points)], many)
                flat = np.concatenate([*sets, np.empty(0, np.uint64)])
                owner, key = order.firsts(flat, np.array([len(s) for s in sets], np.int64), similar)
                ends = np.cumsum(np.bincount(owner, minlength=len(sets)))
                keys = pa.ListArray.from_arrays(pa.array(np.r_[0, ends].astype(np.int32)), pa.array(key.view(np.int64)))
            columns = [batch.column(0), pa.array(names, pa.binary()), pa.array(points), rows, keys]
            yield pa.RecordBatch.from_arrays(columns, names=["id", "node", "point", "fingerprint", "keys"])

    kind = docs.schema["id"].dataType.simpleString()
    return docs.mapInArrow(run, f"id {kind}, node binary, point long, fingerprint array<long>, keys array<long>")


def _postings(docs: DataFrame, words: int, similar: tuple[int, int]) -> DataFrame:
    """(key, point): points with a key in common belong together.

    What keys join within a slice shares a key of its own with one point there, which has the keys of all.
    """
    bands = Bands(similar)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, sets, _, points in _named_sets(batches, words):
            flat = np.concatenate([*sets, np.empty(0, np.uint64)])
            row, key = bands.keys(flat, np.array([len(s) for s in sets], np.int64))
            root = _joined(row, key, points)
            at = points[root[row]]
            order = np.lexsort((at, key))
            at, key = at[order], key[order]
            opens = np.flatnonzero(np.r_[True, (key[1:] != key[:-1]) | (at[1:] != at[:-1])][: len(key)])
            inner = np.flatnonzero(points != points[root])
            own = _mix(points[inner].view(np.uint64) ^ _mix(points[root[inner]].view(np.uint64)))
            keys = np.concatenate([key[opens], own, own])
            ends = np.concatenate([at[opens], points[inner], points[root[inner]]])
            yield pa.RecordBatch.from_arrays([pa.array(keys.view(np.int64)), pa.array(ends)], names=["key", "point"])

    return docs.mapInArrow(run, "key long, point long")


def _clusters(postings: DataFrame) -> DataFrame:
    """(point, cluster) of the points that share a key with another."""
    # rows of a key: one per slice of the rows at most
    order = Window.partitionBy("key").orderBy("point")
    chained = postings.withColumn("before", F.lag("point").over(order)).where("before <> point")
    edges = chained.select(F.col("point").alias("u"), F.col("before").alias("v"))
    return components(edges).select(F.col("node").alias("point"), F.col("root").alias("cluster"))


def _packed(row: np.ndarray, bit: np.ndarray, rows: int, bits: int, parity: bool) -> np.ndarray:
    """Rows of bits as 64-bit words: set, or flipped for every time they are named."""
    words = -(-bits // 64)
    out = np.zeros(rows * words, np.uint64)
    at = row * words + (bit >> 6)
    one = np.uint64(1) << (bit & 63).astype(np.uint64)
    (np.bitwise_xor if parity else np.bitwise_or).at(out, at, one)
    return out.reshape(rows, words)


def verified_forest(flat: np.ndarray, sizes: np.ndarray, split: int, similar: tuple[int, int]) -> tuple[np.ndarray, np.ndarray]:
    """Links (i, j) that join whatever is linked among sets; those before ``split`` with those after it, or all if it is 0."""
    num, den = similar
    rows = len(sizes)
    owner = np.repeat(np.arange(rows), sizes)
    most = max(64, min(_SKETCH, 1 << int(sizes.max(initial=1) - 1).bit_length()))
    sketch = _packed(owner, (flat % np.uint64(most)).astype(np.int64), rows, most, parity=True)
    exact: np.ndarray | None = None
    label = np.arange(rows)
    left = np.arange(split or rows)
    right = np.arange(split, rows)
    found_i, found_j = [], []
    step = max(1, _AT_ONCE // max(1, len(right) * sketch.shape[1]))
    for k in range(0, len(left), step):
        own = left[k : k + step]
        a, b = sizes[own][:, None], sizes[right][None, :]
        open_ = (np.minimum(a, b) * den >= np.maximum(a, b) * num) & (label[own][:, None] != label[right][None, :])
        if not split:
            open_ &= own[:, None] < right[None, :]
        i, j = np.nonzero(open_)
        i, j = own[i], right[j]
        if not len(i):
            continue
        differ = np.bitwise_count(sketch[i] ^ sketch[j]).sum(axis=1, dtype=np.int64)
        near = differ * (den + num) <= (sizes[i] + sizes[j]) * (den - num)
        order = np.argsort(differ[near], kind="stable")
        i, j = i[near][order], j[near][order]
        if len(i) and exact is None:
            # bits of the shingles that stand in two sets
            _, ids, counts = np.unique(flat, return_inverse=True, return_counts=True)
            shared = counts > 1
            number = np.cumsum(shared) - 1
            some = shared[ids]
            exact = _packed(owner[some], number[ids[some]], rows, max(1, int(shared.sum())), parity=False)
        while len(i):
            u, v = label[i], label[j]
            apart = u != v
            i, j = i[apart], j[apart]
            if not len(i):
                break
            # the nearest first; what they join needs no other pair
            part = max(1, _AT_ONCE // exact.shape[1])
            p, q, i, j = i[:part], j[:part], i[part:], j[part:]
            both = np.bitwise_count(exact[p] & exact[q]).sum(axis=1, dtype=np.int64)
            links = both * den >= (sizes[p] + sizes[q] - both) * num
            p, q = p[links], q[links]
            while len(p):
                u, v = label[p], label[q]
                apart = u != v
                p, q, u, v = p[apart], q[apart], u[apart], v[apart]
                # each group takes one link to a group of a smaller number, so there is no circle
                group, at = np.unique(np.maximum(u, v), return_index=True)
                found_i.append(p[at])
                found_j.append(q[at])
                label[group] = np.minimum(u, v)[at]
                while (label != label[label]).any():
                    label = label[label]
    none = np.empty(0, np.int64)
    return np.concatenate([*found_i, none]), np.concatenate([*found_j, none])


def _links(members: DataFrame, similar: tuple[int, int], tile_shingles: int, tile_rows: int) -> DataFrame:
    """(u, v): a forest of verified links per task; ``members`` has (cluster, node, band, shingles), each node once."""
    weight = F.size("shingles").cast("long") + 1
    weighed = members.groupBy("cluster", "band").agg(F.sum(weight).alias("weight"), F.count("*").alias("rows"))
    whole = weighed.groupBy("cluster").agg(F.sum("weight").alias("all_weight"), F.sum("rows").alias("all_rows"))
    tiles = F.greatest(F.ceil(F.col("weight") / tile_shingles), F.ceil(F.col("rows") / tile_rows)).cast("int")
    small = (F.col("all_weight") <= tile_shingles) & (F.col("all_rows") <= tile_rows)
    cells = materialise(weighed.join(whole, "cluster").select("cluster", "band", tiles.alias("tiles"), small.alias("small"), "weight"), "cells")
    bundles = cells.where("small").agg(F.coalesce(F.ceil(F.sum("weight") / tile_shingles), F.lit(1))).first()[0]

    placed = members.join(cells.select("cluster", "band", "tiles", "small"), ["cluster", "band"])
    bundle = F.pmod(F.xxhash64(F.lit("bundle"), "cluster"), F.lit(int(bundles)))
    together = placed.where("small").select(
        F.struct(bundle.alias("a"), F.lit(0).cast("long").alias("b"), F.lit(0).cast("long").alias("c")).alias("task"),
        F.lit(0).alias("side"),
        "cluster",
        "node",
        "shingles",
    )
    # a tile of a large cluster meets itself, later tiles of its band and all tiles of the next
    each = cells.where("not small").select("cluster", "band", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)).alias("tile"))
    a = each.select("cluster", F.col("band").alias("band_a"), F.col("tile").alias("tile_a"))
    b = each.select("cluster", F.col("band").alias("band_b"), F.col("tile").alias("tile_b"))
    meetings = materialise(
        a.join(b, "cluster").where("band_b = band_a and tile_b >= tile_a or band_b = band_a + 1"), "meetings"
    )
    sides = meetings.select(
        "cluster",
        F.struct(
            F.xxhash64("cluster", "band_a", "tile_a").alias("a"), F.xxhash64("cluster", "band_b", "tile_b").alias("b"), F.col("cluster").alias("c")
        ).alias("task"),
        F.explode(
            F.array(
                F.struct(F.lit(0).alias("side"), F.col("band_a").alias("band"), F.col("tile_a").alias("tile")),
                F.struct(F.lit(1).alias("side"), F.col("band_b").alias("band"), F.col("tile_b").alias("tile")),
            )
        ).alias("s"),
    ).where("task.a <> task.b or s.side = 0")
    sides = sides.select("cluster", "task", F.col("s.side").alias("side"), F.col("s.band").alias("band"), F.col("s.tile").alias("tile"))
    large = placed.where("not small").withColumn("tile", F.pmod(F.xxhash64(F.lit("tile"), "node"), F.col("tiles")).cast("int"))
    apart = large.join(sides, ["cluster", "band", "tile"]).select("task", "side", "cluster", "node", "shingles")

    def compare(t: pa.Table) -> pa.Table:
        t = t.sort_by([("cluster", "ascending"), ("side", "ascending")]).combine_chunks()
        lists = t.column("shingles").combine_chunks()
        sizes = pa.compute.list_value_length(lists).to_numpy(zero_copy_only=False).astype(np.int64)
        flat = lists.flatten().to_numpy(zero_copy_only=False).view(np.uint64)
        begins = np.r_[0, np.cumsum(sizes)]
        cluster, side = (t.column(c).to_numpy() for c in ("cluster", "side"))
        ends = np.flatnonzero(np.r_[cluster[1:] != cluster[:-1], True][: len(t)]) + 1
        out_u, out_v, first = [], [], 0
        for end in ends.tolist():
            second = int((side[first:end] == 0).sum())
            split = second if second < end - first else 0
            i, j = verified_forest(flat[begins[first] : begins[end]], sizes[first:end], split, similar)
            out_u.append(i + first)
            out_v.append(j + first)
            first = end
        none = np.empty(0, np.int64)
        nodes = t.column("node")
        u, v = (nodes.take(pa.array(np.concatenate([*x, none]))) for x in (out_u, out_v))
        return pa.table({"u": u.cast(pa.binary()), "v": v.cast(pa.binary())})

    return together.union(apart).groupBy("task").applyInArrow(compare, "u binary, v binary")


def _distinct(sets: DataFrame) -> DataFrame:
    """(node, least, point, fingerprint): a row per set, with its smallest id."""
    firsts = [F.first(c).alias(c) for c in ("point", "fingerprint")]
    return materialise(sets.groupBy("node").agg(F.min("id").alias("least"), *firsts), "nodes")


def similar_groups(
    docs: DataFrame,
    words: int = 5,
    similar: tuple[int, int] = (4, 5),
    radius: tuple[int, int] | None = None,
    id: str = "doc_id",
    text: str = "text",
    tile_shingles: int = TILE_SHINGLES,
    tile_rows: int = TILE_ROWS,
) -> DataFrame:
    """One row per document: the id and ``component_id``, the smallest id reachable over pairs of similar shingle sets.

    Similar: the intersection is at least ``similar`` (numerator, denominator) of the union.
    Clusters are made of shared keys; with ``radius`` of SimHash candidates instead, sets that share one of their
    first shingles and whose fingerprints differ in at most that many bits of the first word and of all. That moves
    far fewer rows where many texts share passages, and misses the few links whose fingerprints are farther apart.
    """
    rows = docs.select(F.col(id).alias("id"), F.coalesce(F.col(text), F.lit("")).cast("binary").alias("text"))
    if radius is None:
        sets = materialise(_sets(rows, words, similar, None), "sets")
        distinct = _distinct(sets)
        # the keys are some half of the texts' size: computed for their one shuffle, never written
        clusters = _clusters(_postings(rows, words, similar))
    else:
        # keys are some quarter of the texts' size: written beside what takes longer, and removed after their one use
        path = work_path(docs.sparkSession, "keyed")
        keyed = _sets(rows, words, similar, _often(rows, words))
        keyed.write.parquet(path)
        keyed = docs.sparkSession.read.schema(keyed.schema).parquet(path)
        sets = materialise(keyed.select("id", "node"), "sets")
        distinct = _distinct(keyed)
        postings = keyed.select("point", F.explode("keys").alias("key"))
        clusters = components(candidates(postings, distinct, *radius, similar))
        remove(docs.sparkSession, path)
        clusters = clusters.select(F.col("node").alias("point"), F.col("root").alias("cluster"))
    clusters = materialise(clusters, "clusters")
    wanted = distinct.join(clusters, "point").select("node", F.col("least").alias("id"), "cluster")
    # one text per set, of those that may have a similar one; rows of one id are together already
    firsts = (F.first(c).alias(c) for c in ("node", "cluster", "text"))
    chosen = rows.join(wanted, "id").groupBy("id").agg(*firsts).select("node", "cluster", "text")
    bands = Bands(similar)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = _WordHashes()
        for batch in (piece for batch in batches for piece in _slices(batch, 2)):
            found = [shingle_set(t.as_py(), words, known) for t in batch.column(2)]
            sizes = np.array([len(s) for s in found], np.int64)
            shingles = pa.ListArray.from_arrays(
                pa.array(np.r_[0, np.cumsum(sizes)].astype(np.int32)), pa.array(np.concatenate([*found, np.empty(0, np.uint64)]).view(np.int64))
            )
            band = pa.array(bands.of(sizes).astype(np.int32))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), band, shingles], names=["node", "cluster", "band", "shingles"])

    members = materialise(chosen.mapInArrow(run, "node binary, cluster long, band int, shingles array<long>"), "members")
    links = materialise(_links(members, similar, tile_shingles, tile_rows), "links")
    roots = components(links)
    rooted = distinct.select("node", "least").join(roots.select("node", "root"), "node", "left")
    rooted = materialise(rooted.select("node", "least", F.coalesce("root", "node").alias("root")), "rooted")
    least = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    named = rooted.join(least, "root").select("node", "component_id")
    return sets.select("id", "node").join(named, "node").select(F.col("id").alias(id), "component_id")
