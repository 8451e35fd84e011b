"""Packing documents into sequences of at most ``capacity`` tokens, in order.

A task reads its documents in table order as one stream of tokens and cuts it
into windows. Cuts fall on document ends (free), on sentence ends (a penalty) or,
where neither is near, inside a sentence (a larger penalty). Dynamic programming
finds the cuts with the least padding plus penalties: with f the cost up to a
boundary and x its place,

    f(j) = penalty(j) + capacity - x(j) + min over x(j) - x(i) <= capacity of f(i) + x(i)

and the minimum slides along with j, so a monotone queue gives each in constant
time. The stream is planned ``plan_tokens`` at a time and the last, open window of
a plan starts the next one, so a task holds a bounded part of its tokens (or one
document, if that is longer). What is left at a task's end is cut into windows
whose lengths are powers of two, which need no padding.

There is no shuffle, and a task that runs again cuts alike. Token ids are those
of the given tokenizer file. A text is encoded through the faster library for the
same vocabulary where both are known to agree (letters up to U+024F, no special token
and no run without a break over a thousand characters); every other text goes through the tokenizer file itself.

Defined results: a null or empty text is the end token alone; a null id is kept;
repeated rows are packed each; an empty table gives no rows; other columns are
ignored.
"""

from __future__ import annotations

import base64
import re
from bisect import bisect_left
from collections import deque
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

CAPACITY = 2048
SENTENCE_PENALTY = 1.0
FORCED_PENALTY = 8.0
#: a sentence longer than this may be cut, at multiples of it
FORCED_EVERY = 16
PLAN_TOKENS = 1 << 19

# what the faster library may split otherwise, or only with a deep stack or in quadratic time
_UNUSUAL = re.compile("[^\x00-\u024f]|<\\|endoftext\\|>|\\s{1000}|\\S{2000}")


class Encoder:
    """Ids of texts by a tokenizer file, and which ids end a sentence."""

    def __init__(self, tokenizer: str, ranks: str | None, pattern: str | None):
        from tokenizers import Tokenizer

        self.slow = Tokenizer.from_file(tokenizer)
        self.fast = None
        if ranks:
            import tiktoken

            with open(ranks, "rb") as lines:
                known = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
            self.fast = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=known, special_tokens={})
        n = self.slow.get_vocab_size()
        tokens = [self.slow.decode([i], skip_special_tokens=False).rstrip(" \"')") for i in range(n)]
        self.ends_sentence = np.array([t.endswith((".", "!", "?", "\n")) for t in tokens])

    def ids(self, text: str) -> np.ndarray:
        if self.fast is not None and not _UNUSUAL.search(text):
            return np.array(self.fast.encode_ordinary(text), np.uint32)
        return np.array(self.slow.encode(text, add_special_tokens=False).ids, np.uint32)


def boundaries(ends: np.ndarray, free: np.ndarray, every: int = FORCED_EVERY) -> tuple[np.ndarray, np.ndarray]:
    """Places where a stream may be cut and what each cut costs.

    ``ends`` are sentence ends and ``free`` document ends, sorted, as numbers of tokens before them.
    """
    at = np.union1d(ends, free)
    edges = np.concatenate([[0], at])
    gaps = np.diff(edges)
    wide = gaps > every
    forced = [np.arange(a + every, a + gap, every) for a, gap in zip(edges[:-1][wide], gaps[wide])]
    forced = np.concatenate([*forced, np.empty(0, np.int64)])
    places = np.concatenate([at, forced]).astype(np.int64)
    cost = np.concatenate([np.where(np.isin(at, free), 0.0, SENTENCE_PENALTY), np.full(len(forced), FORCED_PENALTY)])
    order = np.argsort(places, kind="stable")
    return places[order], cost[order]


def best_cuts(places: np.ndarray, penalties: np.ndarray, capacity: int = CAPACITY) -> list[int]:
    """The cheapest cuts of a stream that goes on after the last place.

    What lies behind the last cut is an open window, of ``capacity`` at most, that costs nothing
    yet. Neighbouring places are at most ``capacity`` apart.
    """
    x = [0, *places.tolist()]
    pen = [0.0, *penalties.tolist()]
    f, back = [0.0] * len(x), [0] * len(x)
    queue: deque[tuple[float, int]] = deque([(0.0, 0)])
    for j in range(1, len(x)):
        while x[j] - x[queue[0][1]] > capacity:
            queue.popleft()
        least, i = queue[0]
        back[j] = i
        f[j] = pen[j] + capacity - x[j] + least
        g = f[j] + x[j]
        while queue and queue[-1][0] > g:
            queue.pop()
        queue.append((g, j))
    near = range(len(x) - 1, bisect_left(x, x[-1] - capacity) - 1, -1)
    cuts, j = [], min(near, key=f.__getitem__)
    while j:
        cuts.append(x[j])
        j = back[j]
    return cuts[::-1]


def pack(
    docs: DataFrame,
    tokenizer: str,
    ranks: str | None = None,
    pattern: str | None = None,
    id: str = "doc_id",
    text: str = "text",
    end_id: int = 1,
    capacity: int = CAPACITY,
    plan_tokens: int = PLAN_TOKENS,
) -> DataFrame:
    """One row per piece of a document.

    ``id``, ``start`` (ids of the document before the piece), ``length``, ``ids`` (little-endian
    32-bit numbers), ``doc_tokens``, ``sequence_id`` and ``offset`` of the piece in its sequence.
    ``tokenizer`` and ``ranks`` are files that every executor has.
    """
    rows = docs.select(F.col(id).alias("id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    kind = rows.schema["id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(tokenizer, ranks, pattern)
        # one window at most has been carried over, so 2^40 windows per task is beyond any task
        sequence = TaskContext.get().partitionId() << 40
        held: list[tuple[object, np.ndarray, int, int]] = []  # id, tokens, tokens before, tokens in all
        size = 0

        def emit(cuts: list[int]) -> pa.RecordBatch:
            """Hand out the stream up to the last cut and keep the rest."""
            nonlocal held, size, sequence
            columns: list[list] = [[] for _ in range(7)]
            rest, begin, k, base = [], 0, 0, 0
            for name, ids, before, total in held:
                done = 0
                while done < len(ids) and k < len(cuts):
                    here = min(len(ids) - done, cuts[k] - base - done)
                    piece = ids[done : done + here]
                    for column, value in zip(columns, (name, before + done, here, piece.tobytes(), total, sequence, base + done - begin)):
                        column.append(value)
                    done += here
                    if base + done == cuts[k]:
                        begin, k, sequence = cuts[k], k + 1, sequence + 1
                if done < len(ids):
                    rest.append((name, ids[done:], before + done, total))
                base += len(ids)
            held, size = rest, size - (cuts[-1] if cuts else 0)
            kinds = [id_type, pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.int64()]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds)], names=NAMES)

        def plan() -> list[int]:
            stream = np.concatenate([h[1] for h in held])
            ends = np.flatnonzero(encoder.ends_sentence[stream]) + 1
            free = np.cumsum([len(h[1]) for h in held])
            places, penalties = boundaries(ends, free, min(FORCED_EVERY, capacity))
            return best_cuts(places, penalties, capacity)

        id_type = pa.int64()
        for batch in batches:
            id_type = batch.schema.field(0).type
            for name, value in zip(batch.column(0).to_pylist(), batch.column(1)):
                ids = np.append(encoder.ids(value.as_py()), np.uint32(end_id))
                held.append((name, ids, 0, len(ids)))
                size += len(ids)
                if size >= plan_tokens:
                    yield emit(plan())
        if held:
            if size > capacity:
                yield emit(plan())
            powers = [1 << k for k in range(size.bit_length() - 1, -1, -1) if size >> k & 1]
            yield emit(np.cumsum(powers).tolist())

    return (
        rows.mapInArrow(
            run,
            f"id {kind}, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long",
        )
    ).withColumnRenamed("id", id)


NAMES = ["id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset"]
