"""Distinct names for tables whose cleaned names collide."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from medoria.operators.numbering import number_within

_SUFFIXED = r"^(.+)_([1-9][0-9]{0,17})$"


def unique_names(df: DataFrame, base: str, order_by: Sequence[str], out: str) -> DataFrame:
    """``base`` for the first row of a name, ``base_1``, ``base_2``… for the next.

    A suffixed name that is itself the base name of some row is left to that
    row and the number is skipped. ``order_by`` must order the rows of a name
    totally, which makes the result independent of how they are read.
    """
    numbered = number_within(df, [base], order_by, "_rank").withColumn("_rank", F.col("_rank") - 1)

    bases = df.select(base).distinct()
    taken = bases.select(
        F.regexp_extract(base, _SUFFIXED, 1).alias("_base"),
        F.regexp_extract(base, _SUFFIXED, 2).try_cast("bigint").alias("_suffix"),
    ).where("_suffix is not null")
    repeated = numbered.where("_rank = 1").select(F.col(base).alias("_base"))
    taken = taken.join(repeated, "_base", "left_semi")
    if not taken.isEmpty():
        numbered = _skip_taken(numbered, base, taken)

    number = F.col("_rank")
    return numbered.withColumn(
        out, F.when(number == 0, F.col(base)).otherwise(F.concat_ws("_", base, number.cast("string")))
    ).drop("_rank")


def _skip_taken(numbered: DataFrame, base: str, taken: DataFrame) -> DataFrame:
    """Move the suffixes past the taken ones.

    Suffixes and taken numbers share the places 1, 2, 3… of a name. The j-th
    taken number ``s`` has ``s - j`` free places before it, so it stands ahead
    of the repeat number ``s - j + 1``; numbering both together gives each
    repeat its place.
    """
    ahead = number_within(taken, ["_base"], ["_suffix"], "_j").select(
        F.col("_base").alias(base),
        (F.col("_suffix") - F.col("_j") + 1).alias("_rank"),
        F.lit(0).alias("_kind"),
        "_suffix",
    )
    repeats = numbered.where("_rank > 0").withColumn("_kind", F.lit(1))
    placed = number_within(
        repeats.unionByName(ahead, allowMissingColumns=True),
        [base],
        ["_rank", "_kind", "_suffix"],
        "_place",
    )
    moved = (
        placed.where("_kind = 1")
        .drop("_rank", "_kind", "_suffix")
        .withColumnRenamed("_place", "_rank")
    )
    return numbered.where("_rank = 0").unionByName(moved)
