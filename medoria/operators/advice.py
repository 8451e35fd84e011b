"""Whether a table is worth partitioning by a column."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Partition only above this many rows and below this many values.
MIN_ROWS = 10_000
MAX_VALUES = 100


def partition_advice(df: DataFrame, column: str) -> DataFrame:
    """One row ``(n_rows, n_values, partitioned)``; NULL counts as a value.

    The rows are first counted per value, which combines before the shuffle,
    so one frequent value costs no more than a rare one.
    """
    per_value = df.groupBy(column).agg(F.count(F.lit(1)).alias("_rows"))
    return per_value.agg(
        F.coalesce(F.sum("_rows"), F.lit(0)).cast("bigint").alias("n_rows"),
        F.count(F.lit(1)).alias("n_values"),
    ).withColumn(
        "partitioned", (F.col("n_rows") > MIN_ROWS) & (F.col("n_values") < MAX_VALUES)
    )


def partition_column(df: DataFrame, column: str | None) -> str | None:
    """``column`` if the advice is to partition by it."""
    if column is None:
        return None
    return column if partition_advice(df, column).first()["partitioned"] else None
