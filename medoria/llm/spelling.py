"""Spelling variants of words, found through an index of grams of variable length.

Words come from the texts by expressions and are counted; whatever follows works on
distinct words. Two words are near if one inserted, deleted or replaced code point
makes one of the other.

The gram dictionary holds all grams of two code points (a word stands between two
marks) and longer ones, up to ``LONGEST``, only below grams that are frequent: those with
more than a share 1 / ``PARENTS`` of all occurrences, so at most ``PARENTS`` of a length have
longer ones and the dictionary is bounded by that number times the letters. It is what
tasks are sent. A word is decomposed into the longest gram at every place, less those
inside an earlier one.

One edit can change only grams around its place: those that hold it, those that might
grow across it and those that a grown one might swallow. The most that any place affects
is the word's bound. Two near words share all grams of each but as many as its bound, so
among the bound + 1 rarest grams of both there is one they share: only these lists are
merged. A shared gram stands at the same distance from the beginning or from the end,
lengths differ by one at most, so a list is kept per gram, place and length. What shares
a list is verified by its edit distance inside the join; pairs of a list that are not
near are never handed on. Words of at least 2 * ``LONGEST`` - 2 code points always keep a
gram, so nothing is missed; shorter limits are refused.

A word's form is its near word with the largest count (ties: the smallest in code-point
order), if that is at least ``ratio`` times the word's; the root follows forms to the last.
Counts grow by that ratio on each step, so chains are short; they are halved each round.

Defined results: a null text has no words; a null id is the empty string where places are
drawn; repeated rows count each; very long runs are words like any other, worked through
in time proportional to their length; an empty table gives no rows; other columns are
ignored.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from medoria.llm.urls import LOWER, UPPER
from medoria.work import materialise

SHORTEST, LONGEST = 2, 4
PARENTS = 500
BEGIN, END = "^", "$"
LETTERS = "A-Za-zÀ-ÿ"
_FLUSH = 1 << 20


def observed(docs: DataFrame, min_length: int = 6, min_count: int = 5, drop_every: int = 199, id: str = "doc_id", text: str = "text") -> DataFrame:
    """(word, n): how often each word stands in the texts.

    Of one in ``drop_every`` pairs of document and word a code point is dropped, drawn by a
    checksum: misspellings of known frequency. 0: of none.
    """
    runs = F.regexp_extract_all(F.col(text), F.lit(f"[{LETTERS}]{{{min_length},}}"), F.lit(0))
    rows = docs.select(F.coalesce(F.col(id).cast("string"), F.lit("")).alias("id"), F.explode(runs).alias("run"))
    low = rows.select("id", F.translate("run", UPPER, LOWER).alias("word"))
    if drop_every:
        h = F.crc32(F.concat("id", F.lit(":"), "word").cast("binary"))
        at = F.pmod("h", F.char_length("word")).cast("int")
        without = F.concat(F.substr("word", F.lit(1), at), F.substr("word", at + 2))
        low = low.withColumn("h", h).select(F.when(F.col("h") % drop_every == 0, without).otherwise(F.col("word")).alias("word"))
    counts = low.where(F.char_length("word") >= min_length).groupBy("word").agg(F.count("*").alias("n"))
    return counts.where(F.col("n") >= min_count)


def marked(word: str) -> str:
    return BEGIN + word + END


def gram_counts(words: DataFrame) -> DataFrame:
    """(gram, n) of all grams of the distinct words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter[str] = Counter()

        def out() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [pa.array(list(counts), pa.string()), pa.array(list(counts.values()), pa.int64())], names=["gram", "n"]
            )

        for batch in batches:
            for word in batch.column(0).to_pylist():
                s = marked(word)
                for q in range(SHORTEST, LONGEST + 1):
                    counts.update(s[p : p + q] for p in range(len(s) - q + 1))
                if len(counts) > _FLUSH:
                    yield out()
                    counts.clear()
        yield out()

    return words.select("word").mapInArrow(run, "gram string, n long").groupBy("gram").agg(F.sum("n").alias("n"))


def gram_dictionary(words: DataFrame, parents: int = PARENTS) -> dict[str, int]:
    """The grams in use and their counts: pairs of letters, and longer ones below frequent grams."""
    counts = materialise(gram_counts(words), "grams")
    size = F.char_length("gram")
    found = {r["gram"]: r["n"] for r in counts.where(size == SHORTEST).collect()}  # pairs of letters
    above = dict(found)
    for q in range(SHORTEST + 1, LONGEST + 1):
        total = counts.where(size == q - 1).agg(F.sum("n")).first()[0] or 0
        frequent = [g for g, n in above.items() if n * parents > total]  # fewer than ``parents``
        if not frequent:
            break
        prefixes = F.broadcast(words.sparkSession.createDataFrame([(g,) for g in frequent], "prefix string"))
        longer = counts.where(size == q).withColumn("prefix", F.substr("gram", F.lit(1), F.lit(q - 1)))
        above = {r["gram"]: r["n"] for r in longer.join(prefixes, "prefix").select("gram", "n").collect()}
        found |= above
    return found


def decompose(s: str, grams: dict[str, int]) -> list[tuple[int, int]]:
    """(begin, end) of the grams of a marked word: the longest at each place that is not inside an earlier one."""
    out, reached = [], 0
    for p in range(len(s) - SHORTEST + 1):
        end = p + SHORTEST
        for q in range(LONGEST, SHORTEST, -1):
            if p + q <= len(s) and s[p : p + q] in grams:
                end = p + q
                break
        if end > reached:
            out.append((p, end))
            reached = end
    return out


def affected(s: str, pieces: list[tuple[int, int]], inner: set[str]) -> int:
    """The most grams of a marked word that one edit can change; ``inner``: what a longer gram of the dictionary begins with."""
    begins, ends = [p for p, _ in pieces], [e for _, e in pieces]
    most = 0
    for i in range(1, len(s)):
        # places whose longest gram may differ: what lies before the edit begins a longer gram
        first = i
        for p in range(max(0, i - LONGEST + 1), i):
            if s[p:i] in inner:
                first = p
                break
        touched = bisect_left(begins, first)
        inside = bisect_right(begins, i)
        swallowed = bisect_right(ends, i + LONGEST)
        most = max(most, max(inside, swallowed) - touched)
    return most


def beginnings(grams: dict[str, int]) -> set[str]:
    """All proper prefixes of what a gram may be: any pair of letters is one, so any single letter begins one."""
    return {g[:q] for g in grams for q in range(1, len(g))}


def index_rows(words: DataFrame, grams: dict[str, int]) -> DataFrame:
    """(word, n, gram, place, length): the rarest grams of each word, one more than an edit can change."""
    known = words.sparkSession.sparkContext.broadcast((grams, beginnings(grams)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grams, inner = known.value
        for batch in batches:
            rows: list[tuple[int, str, int, int]] = []
            for k, word in enumerate(batch.column(0).to_pylist()):
                s = marked(word)
                pieces = decompose(s, grams)
                keep = affected(s, pieces, inner) + 1
                order = sorted((grams[s[p:e]], s[p:e], p) for p, e in pieces)
                rows += [(k, g, p, len(s)) for _, g, p in order[:keep]]
            at, gram, place, length = zip(*rows) if rows else ((), (), (), ())
            own = batch.take(pa.array(at, pa.int64()))
            yield pa.RecordBatch.from_arrays(
                [*own.columns, pa.array(gram, pa.string()), pa.array(place, pa.int32()), pa.array(length, pa.int32())],
                names=["word", "n", "gram", "place", "length"],
            )

    return words.select("word", "n").mapInArrow(run, "word string, n long, gram string, place int, length int")


def near_pairs(words: DataFrame, min_length: int = 6) -> DataFrame:
    """Distinct (a, n_a, b, n_b), each pair once: words that one edit tells apart."""
    if min_length < 2 * LONGEST - 2:
        raise ValueError(f"words need at least {2 * LONGEST - 2} code points")
    rows = materialise(index_rows(words, gram_dictionary(words)), "grams")

    def keyed(place: Column, length: Column) -> Column:
        return F.xxhash64("gram", place, length)

    place, length = F.col("place"), F.col("length")
    lists = rows.select(keyed(place, length).alias("key"), F.col("word").alias("b"), F.col("n").alias("n_b"), F.col("length").alias("at_b"))
    # in lists of its own length, and in those of the longer: before the place of the edit, and after it
    lookups = F.array(keyed(place, length), keyed(place, length + 1), keyed(place + 1, length + 1))
    probes = rows.select(F.explode(lookups).alias("key"), F.col("word").alias("a"), F.col("n").alias("n_a"), F.col("length").alias("at_a"))
    once = F.expr("at_a < at_b or at_a = at_b and a < b")
    near = F.levenshtein("a", "b", 1) == 1
    found = probes.join(lists, (probes["key"] == lists["key"]) & once & near)
    return found.select("a", "n_a", "b", "n_b").distinct()


def follow(forms: DataFrame) -> DataFrame:
    """(word, root) for a table of (word, form) without circles."""
    state = materialise(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        further = state.select(F.col("word").alias("root"), F.col("root").alias("next"))
        state = materialise(
            state.join(further, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")),
            "roots",
        )
        moved = state.where("moved").limit(1).count()
        state = state.select("word", "root")
        if not moved:
            return state


def variants(words: DataFrame, ratio: int = 5, min_length: int = 6) -> DataFrame:
    """(word, n, n_near, form, form_n, root) of every row of (word, n)."""
    words = materialise(words.select("word", "n"), "words")
    pairs = materialise(near_pairs(words, min_length), "pairs")
    both = pairs.union(pairs.select("b", "n_b", "a", "n_a"))
    best = F.min(F.struct((-F.col("n_b")).alias("less"), F.col("b").alias("word")))
    near = both.groupBy(F.col("a").alias("word"), F.col("n_a").alias("n")).agg(F.count("*").alias("n_near"), best.alias("best"))
    is_form = -F.col("best.less") >= ratio * F.col("n")
    near = materialise(
        near.select(
            "word",
            "n_near",
            F.when(is_form, F.col("best.word")).alias("form"),
            F.when(is_form, -F.col("best.less")).alias("form_n"),
        ),
        "near",
    )
    roots = follow(near.where(F.col("form").isNotNull()))
    out = words.join(near, "word", "left").join(roots, "word", "left")
    return out.select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), "form", "form_n", F.coalesce("root", "word").alias("root")
    )
