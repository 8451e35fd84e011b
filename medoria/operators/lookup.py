"""Left joins of a large table to a smaller one."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.types import (
    ArrayType,
    BinaryType,
    BooleanType,
    DateType,
    IntegerType,
    MapType,
    NumericType,
    StructField,
    StructType,
    TimestampType,
)

MAX_BROADCAST_ROWS = 2_000_000
MAX_BROADCAST_BYTES = 64 * 1024 * 1024
MIN_HEAVY_ROWS = 10_000  # fewer rows are no burden to a task
MIN_TRACKED, MAX_TRACKED = 1024, 1_000_000  # keys a sketch holds


def _bytes(df: DataFrame) -> Column:
    """About what the rows take in memory, added up."""
    width = F.lit(16 * len(df.columns))
    for field in df.schema:
        if isinstance(field.dataType, NumericType | DateType | TimestampType | BooleanType):
            width = width + 8
        else:
            width = width + F.coalesce(F.octet_length(F.col(f"`{field.name}`").cast("string")), F.lit(0))
    return F.coalesce(F.sum(width), F.lit(0))


def _splits_skew(df: DataFrame) -> bool:
    """Whether the session splits the partitions of frequent keys itself, as it joins."""
    read = df.sparkSession.conf.get
    return all(read(f"spark.sql.adaptive.{name}") == "true" for name in ("enabled", "skewJoin.enabled"))


def _fits(rows: int, size: int, max_rows: int | None, max_bytes: int | None) -> bool:
    max_rows = MAX_BROADCAST_ROWS if max_rows is None else max_rows
    max_bytes = MAX_BROADCAST_BYTES if max_bytes is None else max_bytes
    return rows <= max_rows and size <= max_bytes


def broadcastable(df: DataFrame, max_rows: int | None = None, max_bytes: int | None = None) -> bool:
    """Whether the whole of ``df`` was measured to fit the bounds; one row returns to the driver."""
    measured = df.agg(F.count(F.lit(1)).alias("rows"), _bytes(df).alias("bytes")).first()
    return _fits(measured["rows"], measured["bytes"], max_rows, max_bytes)


def _token(df: DataFrame, key: str) -> str:
    """What stands for a key in a sketch, as SQL: the key, or a hash of it where sketches do not take its type."""
    if isinstance(df.schema[key].dataType, ArrayType | MapType | StructType | BinaryType):
        return f"if(`{key}` is null, null, xxhash64(`{key}`))"
    return f"`{key}`"


def _sketch(df: DataFrame, key: str, parts: int) -> list[Column]:
    """Rows, rows without a key, and the most frequent keys with about their rows.

    A sketch of bounded size per task, merged: a key with over an even share of one of ``parts``
    partitions is in it, its count is off by less than a third of that share.
    """
    tracked = min(MAX_TRACKED, max(MIN_TRACKED, 8 * parts))
    top = F.expr(f"approx_top_k({_token(df, key)}, {min(parts, tracked)}, {tracked})")
    return [F.count(F.lit(1)).alias("rows"), F.count_if(F.col(key).isNull()).alias("nulls"), top.alias("top")]


def _shares(found: Row, parts: int) -> dict:
    """Keys that hold more than an even share of one partition, with the partitions they would fill."""
    counted = {item["item"]: item["count"] for item in found["top"] or ()}
    if found["nulls"]:
        counted[None] = found["nulls"]
    return {
        key: math.ceil(n * parts / found["rows"])
        for key, n in counted.items()
        if n * parts > found["rows"] and n >= MIN_HEAVY_ROWS
    }


def heavy_keys(df: DataFrame, key: str, parts: int) -> DataFrame:
    """Keys (or what stands for them) with more rows than an even share of one partition, with their split; one pass over the keys.

    ``_parts`` is how many average partitions the rows of the key would fill.
    Each listed key holds over ``1/parts`` of the rows, so there are fewer
    than ``parts`` of them whatever the data looks like. NULL counts as a key.
    """
    shares = _shares(df.agg(*_sketch(df, key, parts)).first(), parts)
    kind = df.select(F.expr(_token(df, key))).schema[0].dataType
    schema = StructType([StructField("_heavy_key", kind), StructField("_parts", IntegerType())])
    return df.sparkSession.createDataFrame([*shares.items()], schema)


def _salted(df: DataFrame, other: DataFrame, key: str, hot: dict, crowded: dict, spread_by: str | None) -> DataFrame:
    """Shuffled left join that deals the rows of frequent keys over a grid of salts.

    ``hot`` keys are frequent in ``df``: its rows are dealt over ``_a``, and ``other``'s rows of
    these keys are repeated for each. ``crowded`` ones are frequent in ``other``, whose rows are dealt
    over ``_b``. A row of ``df`` with a crowded key has a match at one ``_b`` at least, so where
    it has none it is left out.
    """
    spark = df.sparkSession
    token = F.expr(_token(df, key))
    kind = df.select(token).schema[0].dataType
    fields = [StructField("_key", kind), StructField("_as", IntegerType()), StructField("_bs", IntegerType())]
    table = [(k, hot.get(k, 1), crowded.get(k, 1)) for k in {**hot, **crowded}]
    salts = F.broadcast(spark.createDataFrame(table, StructType(fields)))  # fewer than two keys per partition
    matches = token.eqNullSafe(F.col("_key"))
    n_a, n_b = F.coalesce("_as", F.lit(1)), F.coalesce("_bs", F.lit(1))
    place = F.xxhash64(spread_by) if spread_by else F.monotonically_increasing_id()

    def each(n: Column) -> Column:
        return F.explode(F.sequence(F.lit(0), n - 1))

    dealt = (
        df.withColumn("_row", place)
        .join(salts, matches, "left")
        .withColumns({"_a": F.pmod("_row", n_a).cast("int"), "_several": n_b > 1})
        .withColumn("_b", each(n_b))
        .drop("_row", "_key", "_as", "_bs")
    )
    # equal rows fall on one salt, whoever made them
    repeated = (
        other.withColumn("_row", F.xxhash64(*other.columns))
        .join(salts, matches, "left")
        .withColumns({"_b": F.pmod("_row", n_b).cast("int"), "_hit": F.lit(True)})
        .withColumn("_a", each(n_a))
        .drop("_row", "_key", "_as", "_bs")
    )
    joined = dealt.join(repeated, [key, "_a", "_b"], "left").where(F.col("_hit").isNotNull() | ~F.col("_several"))
    return joined.drop("_a", "_b", "_several", "_hit")


def lookup(
    df: DataFrame,
    other: DataFrame,
    key: str,
    spread_by: str | None = None,
    max_rows: int | None = None,
    max_bytes: int | None = None,
) -> DataFrame:
    """Left join on one column of the same name.

    ``other`` is broadcast when measured to be small: at most ``max_rows`` rows
    and ``max_bytes``, to be set by the memory of an executor. Otherwise the join shuffles.
    Adaptive execution then splits the partitions of keys that are frequent on either side. In a session
    without it the keys of both sides are sketched, in one pass each, and rows of
    frequent keys are dealt over as many salts as they fill partitions, and the other
    side's rows of these keys are repeated per salt.

    A task that is run again must deal its rows as before. ``spread_by`` is a
    column that differs between the rows of a key; without it the position in
    the input decides, which is right when ``df`` is a scan with row-wise steps.
    """
    if broadcastable(other, max_rows, max_bytes):
        return df.join(F.broadcast(other), key, "left")
    if _splits_skew(df):
        return df.join(other, key, "left")
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    measured = other.agg(*_sketch(other, key, parts)).first()
    crowded = {k: n for k, n in _shares(measured, parts).items() if k is not None}
    if _token(other, key) != f"`{key}`":
        crowded = {}  # two keys may have one hash, so a match is not certain
    hot = _shares(df.agg(*_sketch(df, key, parts)).first(), parts)
    if not hot and not crowded:
        return df.join(other, key, "left")
    return _salted(df, other, key, hot, crowded, spread_by)
