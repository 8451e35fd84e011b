"""What several operators share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def held_out(doc_id: Column) -> Column:
    """Rows whose labels may not be learnt: crc32 of the id as text, modulo 4, is 2 (a null id: no)."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def bounded_sample(df: DataFrame, key: str, at_most: int) -> DataFrame:
    """About ``at_most`` rows, chosen by a hash of ``key``; every row while there are no more.

    The choice depends on the key alone, so it is the same on every run and in every task.
    """
    n = df.count()
    if n <= at_most:
        return df
    share = int(at_most / n * (1 << 30))
    return df.where(F.pmod(F.xxhash64(F.lit("fit"), F.col(key)), F.lit(1 << 30)) < share)


def finite(vector: Column) -> Column:
    """Whether a vector is there and holds neither nulls nor components that are not finite."""
    x = vector.cast("array<double>")
    every = F.forall(x, lambda e: e.isNotNull() & ~F.isnan(e) & (F.abs(e) != float("inf")))
    return F.coalesce(vector.isNotNull() & every, F.lit(False))
