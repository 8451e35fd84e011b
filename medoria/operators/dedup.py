"""One row per key."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def keep_one(df: DataFrame, key: str) -> DataFrame:
    """The row with the fewest NULLs per key, ties to the smallest values.

    Rows without the key go: nothing can refer to them. It is an aggregation,
    so copies of a key collapse before the shuffle and no group is sorted.
    """
    payload = [name for name in df.columns if name != key]
    present = df.where(F.col(key).isNotNull())
    if not payload:
        return present.distinct()
    gaps: Column = reduce(
        lambda a, b: a + b, [F.col(name).isNull().cast("int") for name in payload]
    )
    best = F.min(F.struct(gaps.alias("_gaps"), *payload)).alias("_best")
    return (
        present.groupBy(key)
        .agg(best)
        .select(*[F.col(name if name == key else f"_best.{name}") for name in df.columns])
    )
