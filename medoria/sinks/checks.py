"""Counts, fingerprints and relocation of tables."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from medoria.files import nested
from medoria.sinks.catalog import location_of, move_entry
from medoria.sinks.generations import new_generation
from medoria.sinks.report import EMPTY, FAILED, OK, Outcome


GAP_BITS = 62  # missing values told by one number
PIECE_BITS = 22  # of a hash, summed apart


def verify_tables(spark: SparkSession, database: str, names: Iterable[str]) -> DataFrame:
    """``(table_name, status, n_rows, n_cols, error)`` of each table, counted in one job."""
    counts, missing = [], []
    for name in names:
        try:
            table = spark.table(f"{database}.{name}")
        except PySparkException as error:
            missing.append((name, FAILED, None, None, str(error)))
            continue
        rows = F.count(F.lit(1))
        counts.append(
            table.agg(
                F.lit(name).alias("table_name"),
                F.when(rows > 0, F.lit(OK)).otherwise(F.lit(EMPTY)).alias("status"),
                rows.alias("n_rows"),
                F.lit(len(table.columns)).alias("n_cols"),
                F.lit(None).cast("string").alias("error"),
            )
        )
    if missing:
        schema = "table_name string, status string, n_rows bigint, n_cols int, error string"
        counts.append(spark.createDataFrame(missing, schema))
    return reduce(DataFrame.unionByName, counts)


def _row_hashes(names: Iterable[str]) -> dict[str, Column]:
    """Two independent 64-bit hashes of a row; which of its values are missing counts."""
    columns = [F.col(f"`{name}`") for name in names]
    # a hash passes over missing values, so their places are hashed too: as bits of numbers
    gaps = [
        reduce(lambda a, b: a + b, [F.isnull(c).cast("bigint") * (1 << k) for k, c in enumerate(columns[i : i + GAP_BITS])])
        for i in range(0, len(columns), GAP_BITS)
    ]
    return {
        "h1": F.xxhash64(*columns, *gaps),
        "h2": F.xxhash64(F.lit("second"), *reversed(columns), *gaps),
    }


def _hashes(names: Iterable[str]) -> dict[str, Column]:
    return {name: h.cast("decimal(20,0)") for name, h in _row_hashes(names).items()}


def fingerprint(df: DataFrame) -> DataFrame:
    """One row that depends on all rows, and on how often each occurs, not on their order.

    Two hashes are summed exactly; nothing is shuffled but one row per task. A hash is summed in
    pieces of 22 bits, as 64-bit numbers that 2^41 rows do not fill, and put together at the end:
    sums of decimals would take most of the time of the pass.
    """
    rest = F.lit((1 << PIECE_BITS) - 1).cast("bigint")
    sums = [F.count(F.lit(1)).alias("n_rows")]
    whole = []
    for name, h in _row_hashes(df.columns).items():
        pieces = [
            h.bitwiseAND(rest),
            F.shiftright(h, PIECE_BITS).bitwiseAND(rest),
            F.shiftright(h, 2 * PIECE_BITS),  # with the sign
        ]
        sums += [F.sum(piece).alias(f"{name}_{k}") for k, piece in enumerate(pieces)]
        weighed = [F.col(f"{name}_{k}").cast("decimal(20,0)") * (1 << (PIECE_BITS * k)) for k in range(len(pieces))]
        whole.append(reduce(lambda a, b: a + b, weighed).cast("decimal(38,0)").alias(name))
    return df.agg(*sums).select("n_rows", *whole)


def differences(
    left: DataFrame,
    right: DataFrame,
    partition_by: Iterable[str] = (),
    bucket: Column | None = None,
    buckets: int = 64,
) -> DataFrame:
    """Where two copies of a table differ: the parts of it whose rows are not the same, and how many rows they have.

    A tree of sums of hashes: the ``table`` is made of its ``partition``s (values of
    ``partition_by``), these of ``bucket``s, and ``level`` says what a row is. Equal copies have no
    rows. ``bucket`` is a number that a row keeps when it is damaged, such as a hash of
    its key; without it the hash of the whole row is taken, and a changed row shows in
    two buckets. Each side is read once, and what is shuffled is at most one row per task
    and bucket, however many rows a partition has.
    """
    partition_by = list(partition_by)
    if sorted(left.columns) != sorted(right.columns):
        raise ValueError(f"the copies have other columns: {left.columns} and {right.columns}")
    hashes = _hashes(left.columns)
    place = F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in left.columns]), F.lit(buckets)) if bucket is None else bucket

    def side(df: DataFrame, sign: int) -> DataFrame:
        return df.select(
            *[F.col(f"`{c}`") for c in partition_by],
            place.alias("bucket"),
            *[(h * sign).cast("decimal(21,0)").alias(name) for name, h in hashes.items()],
            F.lit(sign).alias("sign"),
        )

    # what is equal on both sides cancels out
    sums = [F.sum("h1").alias("h1"), F.sum("h2").alias("h2")]
    leaves = (
        side(left, 1)
        .unionByName(side(right, -1))
        .groupBy(*partition_by, "bucket")
        .agg(F.count_if(F.col("sign") > 0).alias("rows_left"), F.count_if(F.col("sign") < 0).alias("rows_right"), *sums)
    )
    parts = [F.col(f"`{c}`") for c in partition_by]
    level = F.when(F.grouping("bucket") == 0, "bucket")
    if parts:
        level = level.when(F.grouping(parts[0]) == 0, "partition")
    tree = leaves.groupingSets([[], *([parts] if parts else []), [*parts, F.col("bucket")]], *parts, "bucket").agg(
        level.otherwise("table").alias("level"),
        F.sum("rows_left").alias("rows_left"),
        F.sum("rows_right").alias("rows_right"),
        *sums,
    )
    unlike = (F.col("rows_left") != F.col("rows_right")) | (F.col("h1") != 0) | (F.col("h2") != 0)
    return tree.where(unlike).select("level", *parts, "bucket", "rows_left", "rows_right")


NAMED = 5  # places that a message names; ``differences`` has all


def _places(left: DataFrame, right: DataFrame, partition_by: list[str]) -> str:
    """The first places where two copies differ, in words."""
    level = "partition" if partition_by else "bucket"
    found = differences(left, right, partition_by).where(F.col("level") == level)
    names = partition_by or ["bucket"]
    first = found.orderBy(*names).limit(NAMED + 1).collect()
    told = [
        ", ".join(f"{c}={r[c]}" for c in names) + f" ({r['rows_left']} rows, {r['rows_right']} in the copy)"
        for r in first[:NAMED]
    ]
    return "; ".join(told) + ("; and more" if len(first) > NAMED else "")


def same_rows(left: DataFrame, right: DataFrame) -> bool:
    return left.columns == right.columns and fingerprint(left).first() == fingerprint(right).first()


def _copy_at(target: str, source: DataFrame, table_format: str) -> DataFrame:
    copy = source.sparkSession.read.format(table_format).schema(source.schema).load(target)
    return copy.select(*source.columns)


def relocate(
    spark: SparkSession,
    database: str,
    name: str,
    location: str,
    partition_by: Iterable[str] = (),
    table_format: str = "parquet",
) -> Outcome:
    """Copy a table below another place, compare, then point the entry there.

    The copy is a new generation at ``location``; nothing that is there is
    overwritten or removed, and the old files stay. A place that holds the
    table's files, or lies in them, is refused. An empty table is left alone. The
    entry moves only after the copy was found equal. What goes wrong is in the
    outcome; of a copy that differs, the partitions (or buckets of rows) that do.
    """
    table = f"{database}.{name}"
    try:
        source = spark.table(table)
        columns = len(source.columns)
        if nested(spark, location_of(spark, database, name), location):
            return Outcome(name, FAILED, None, columns, f"{table} is already at or around {location}")
        if source.isEmpty():
            return Outcome(name, EMPTY, 0, columns)

        partition_by = list(partition_by)
        target = new_generation(location)
        # the files of a table hold one partition each, so copying needs no shuffle
        source.write.format(table_format).mode("errorifexists").partitionBy(*partition_by).save(target)
        copy = _copy_at(target, source, table_format)
        before, after = fingerprint(source).union(fingerprint(copy)).collect()  # two rows
        if before != after:
            where = _places(source, copy, partition_by)
            return Outcome(name, FAILED, after["n_rows"], columns, f"the copy at {target} differs from {table}: {where}")
        move_entry(spark, database, name, target, source.schema, partition_by, table_format)
    except (PySparkException, Py4JJavaError) as error:
        return Outcome(name, FAILED, error=str(error))
    return Outcome(name, OK, after["n_rows"], columns)
