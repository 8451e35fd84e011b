"""Which raw files there are and which table each becomes."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from medoria.files import SCHEME, children, matching, qualified
from medoria.functions import size_mb, table_name_of
from medoria.operators import unique_names


def _below(spark: SparkSession, root: str) -> Column:
    """What follows the root in the path of a file: an anchored prefix, never a later occurrence."""
    place = re.sub(SCHEME, "", qualified(spark, root)).rstrip("/") + "/"
    plain = F.regexp_replace("path", SCHEME, "")
    return F.when(F.startswith(plain, F.lit(place)), F.substr(plain, F.lit(len(place) + 1)))


def discover(spark: SparkSession, root: str, extension: str, target_root: str) -> DataFrame:
    """Manifest ``(table_name, source_path, target_path, n_files, length, file_size_mb)``.

    Files are found at any depth. A folder that itself carries the extension
    (``visits.csv/part-…``, as distributed writers leave it) is one source.
    Only paths and lengths are read, never contents. Spark reads no file whose
    name begins with ``_`` or ``.``: ``unreadable_names`` lists those.
    """
    return discover_states(spark, root, extension, target_root).drop("state")


def discover_states(spark: SparkSession, root: str, extension: str, target_root: str) -> DataFrame:
    """The manifest of ``discover`` with a ``state`` of every source: of its files' paths, lengths and times of change."""
    suffix = re.escape(f".{extension}")
    files = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", True)
        .option("pathGlobFilter", f"*.{extension}")
        .load(root)
        .select("path", "length", "modificationTime", _below(spark, root).alias("below"))
    )
    source = F.regexp_extract("below", rf"^(.*?{suffix})(/|$)", 1)
    parts = F.length("below") - F.length("relative")  # what follows the name of a folder source
    sources = (
        files.withColumn("relative", source)
        .withColumn("source_path", F.substr("path", F.lit(1), F.length("path") - parts))
        .groupBy("relative", "source_path")
        .agg(
            F.count(F.lit(1)).alias("n_files"),
            F.sum("length").alias("length"),
            # whatever the order of the files
            F.sum(F.xxhash64("path", "length", "modificationTime").cast("decimal(38,0)")).cast("string").alias("state"),
        )
        .withColumn("base", table_name_of(F.col("relative")))
    )
    return unique_names(sources, "base", ["relative"], "table_name").select(
        "table_name",
        "source_path",
        F.concat(F.lit(f"{target_root.rstrip('/')}/"), "table_name").alias("target_path"),
        "n_files",
        "length",
        size_mb(F.col("length")).alias("file_size_mb"),
        "state",
    )


def unreadable_names(spark: SparkSession, root: str, extension: str) -> list[str]:
    """Sources below the root that Spark hides, because their name or a folder's begins with ``_`` or ``.``.

    One pattern per depth, so only the hidden names themselves come back.
    """
    place, found, depth = qualified(spark, root), [], "/*"
    if not children(spark, place):
        return []
    while True:
        above = place + depth[:-2]
        found += matching(spark, f"{above}/[_.]*.{extension}")
        # a hidden folder hides what is in it
        found += matching(spark, f"{above}/[_.]*/*.{extension}")
        if not matching(spark, place + depth + "/*"):
            # what lies in a folder source is that source
            return sorted(f for f in set(found) if not any(f.startswith(other + "/") for other in found))
        depth += "/*"
