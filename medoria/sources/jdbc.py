"""Relational tables as sources."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def jdbc_options(
    url: str,
    table: str,
    column: str,
    lower: int | str,
    upper: int | str,
    partitions: int,
    properties: dict[str, str] | None = None,
) -> dict[str, str]:
    """Options of a scan split into ranges of ``column``.

    The bounds only set the stride: rows outside them go to the outer ranges,
    so nothing is filtered out.
    """
    if partitions < 1:
        raise ValueError("partitions must be at least 1")
    return {
        **(properties or {}),
        "url": url,
        "dbtable": table,
        "partitionColumn": column,
        "lowerBound": str(lower),
        "upperBound": str(upper),
        "numPartitions": str(partitions),
    }


def read_jdbc(spark: SparkSession, **scan) -> DataFrame:
    """A relational table read by several tasks at once; see ``jdbc_options``."""
    return spark.read.format("jdbc").options(**jdbc_options(**scan)).load()
