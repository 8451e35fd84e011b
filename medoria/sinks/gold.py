"""Gold tables: every overwrite is a new generation the catalog then points to."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from medoria.operators import partition_column
from medoria.sinks.catalog import move_entry
from medoria.sinks.generations import new_generation, newest, retire
from medoria.specs import TableSpec, conform

KEEP = 2


def _read(spark: SparkSession, spec: TableSpec, location: str, table_format: str) -> DataFrame:
    written = spark.read.format(table_format).schema(spec.schema).load(location)
    return written.select(*spec.schema.names)


def read_table(spark: SparkSession, spec: TableSpec, root: str, table_format: str = "parquet") -> DataFrame:
    """A gold table by its place alone: the newest complete content below ``root``."""
    location = newest(spark, f"{root.rstrip('/')}/{spec.name}")
    if location is None:
        raise FileNotFoundError(f"no content of {spec.name} below {root}")
    return _read(spark, spec, location, table_format)


def replace_table(
    df: DataFrame,
    database: str,
    spec: TableSpec,
    root: str,
    table_format: str = "parquet",
    keep: int = KEEP,
) -> DataFrame:
    """Write ``df`` as the new content of the table and return that content.

    The new content is written beside the old one and the entry is moved when
    it is complete, so ``df`` may read the table it replaces. What is returned
    are these very files, until ``keep`` later overwrites have removed them.

    The layout is chosen before: the rows are counted per value of the column of the
    contract, a pass that computes this column alone, and are then written once.
    """
    spark = df.sparkSession
    df = conform(df, spec)
    folder = f"{root.rstrip('/')}/{spec.name}"

    column = partition_column(df, spec.adaptive_by)
    partitions = [column] if column is not None else []
    rows = df
    if column is not None:
        # a value's rows meet in few files, and a frequent value is split
        rows = rows.hint("rebalance", column)
    if spec.sort_by is not None:
        rows = rows.sortWithinPartitions(*partitions, spec.sort_by)
    location = new_generation(folder)
    rows.write.format(table_format).mode("errorifexists").partitionBy(*partitions).save(location)
    move_entry(spark, database, spec.name, location, spec.schema, partitions, table_format)
    retire(spark, folder, keep)
    return _read(spark, spec, location, table_format)
