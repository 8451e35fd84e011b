"""Tables kept in buckets of a key, so that tables of the same key are joined where they lie."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType


def _quoted(*names: str) -> str:
    return ".".join(f"`{name.replace('`', '``')}`" for name in names)


def register_bucketed(
    spark: SparkSession, database: str, name: str, location: str, schema: StructType, key: str, buckets: int
) -> DataFrame:
    """Enter bucketed files into the catalog; the entry is what tells Spark of the buckets."""
    columns = ", ".join(f"{_quoted(f.name)} {f.dataType.simpleString()}" for f in schema)
    place = location.replace("\\", "\\\\").replace("'", "\\'")
    spark.sql(
        f"create table {_quoted(database, name)} ({columns}) using parquet"
        f" clustered by ({_quoted(key)}) sorted by ({_quoted(key)}) into {buckets} buckets location '{place}'"
    )
    return spark.table(_quoted(database, name))


def write_bucketed(df: DataFrame, database: str, name: str, location: str, key: str, buckets: int) -> DataFrame:
    """Write ``df`` as a new table in ``buckets`` of ``key``, one sorted file each, and return the table.

    All rows of a key lie in one bucket, and a bucket is read by one task: ``df`` should have a
    bounded number of rows per key, NULL included. A name that is taken, or a place with files, raises.
    """
    rows = df.repartition(buckets, key).sortWithinPartitions(key)
    writer = rows.write.format("parquet").mode("errorifexists").bucketBy(buckets, key).sortBy(key)
    writer.option("path", location).saveAsTable(_quoted(database, name))
    return df.sparkSession.table(_quoted(database, name))
