"""Silver tables as snappy Parquet."""

from __future__ import annotations

from collections.abc import Collection
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from medoria.files import children, remove
from medoria.functions.sizing import output_files_for
from medoria.work import materialise, scratch


LINEAGE_PATH = "source_file"


@dataclass(frozen=True)
class Written:
    """What a write saw: its rows, and those with a value in each counted column."""

    rows: int
    counted: dict[str, int]


def write_counted(df: DataFrame, path: str, output_files: bool = False, count: Collection[str] = (), leave_out: Collection[str] = ()) -> Written:
    """Overwrite ``path``; rows are counted as they are written. An empty table is not written.

    A table is written in one pass as it was read, one file per input split,
    whatever its size. With ``output_files`` its rows are written apart first
    and then to as many files as the rule of rows calls for, eight at most.
    Columns of ``count`` are counted where they are not null; those of ``leave_out`` are counted at most, not written.
    """
    spark = df.sparkSession
    nothing = Written(0, dict.fromkeys(count, 0))
    replaces = bool(children(spark, path))
    # what is there stays if nothing replaces it, so that has to be known before
    if replaces and df.isEmpty():
        return nothing
    seen = Observation()
    numbers = {"rows": F.count(F.lit(1)), **{f"in_{c}": F.count(F.col(f"`{c}`")) for c in count}}
    observed = df.observe(seen, *(n.alias(name) for name, n in numbers.items())).drop(*leave_out)
    with scratch(spark):
        if output_files:
            observed = materialise(observed, "silver")
            if not seen.get.get("rows"):
                return nothing
            files = output_files_for(seen.get["rows"])
            observed = observed.coalesce(1) if files == 1 else observed.repartition(files)
        # comparing the long path of every row for bounds costs more than writing it; a file's dictionary tells its few paths
        plain = {f"parquet.column.statistics.enabled#{LINEAGE_PATH}": False}
        observed.write.mode("overwrite").options(compression="snappy", **plain).parquet(path)
    found = seen.get
    if not found.get("rows"):
        remove(spark, path)
        return nothing
    return Written(found["rows"], {c: found[f"in_{c}"] for c in count})


def write_silver(df: DataFrame, path: str, output_files: bool = False) -> int:
    """``write_counted`` without columns to count: the rows written."""
    return write_counted(df, path, output_files).rows
