"""Readers for raw CSV, JSON and Parquet."""

from __future__ import annotations

from collections.abc import Collection, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from medoria.sources.csv_files import read_csv, read_csv_as_begun
from medoria.sources.json_files import read_json


class UnsupportedFormat(ValueError):
    """A file format none of the readers knows."""


def read_raw(
    spark: SparkSession,
    path: str,
    file_format: str,
    schema: StructType | None = None,
    text_columns: Collection[str] = (),
    keep_corrupt: bool = False,
    options: Mapping[str, str] | None = None,
    as_begun: bool = False,
) -> DataFrame | None:
    """One source of the given format. Unknown formats raise ``UnsupportedFormat``.

    ``as_begun`` asks for CSV with the types its beginnings tell (``read_csv_as_begun``), None if they do not.
    """
    if as_begun:
        sure = file_format.lower() == "csv" and schema is None and not options
        return read_csv_as_begun(spark, path, text_columns) if sure else None
    match file_format.lower():
        case "csv":
            return read_csv(spark, path, schema, text_columns, keep_corrupt, options)
        case "json":
            return read_json(spark, path, schema)
        case "parquet":
            return spark.read.parquet(path)
        case other:
            raise UnsupportedFormat(f"no reader for format {other!r}")
