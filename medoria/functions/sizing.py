"""Sizes of files and how many output files a table gets."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values: (more rows than, output files), largest first; below the last
# bound a table that has rows gets one file.
FILE_RULE = ((1_000_000, 8), (100_000, 4))


def size_mb(length: Column) -> Column:
    """Bytes as MB with two decimals, half to even; 0.0 when the length is unknown."""
    return F.coalesce(F.bround(length / F.lit(1024 * 1024), 2), F.lit(0.0))


def output_files(rows: Column) -> Column:
    """Output files for a row count; NULL (leave as it is) for none or unknown."""
    rule = F.when(rows.isNull() | (rows <= 0), F.lit(None).cast("int"))
    for bound, files in FILE_RULE:
        rule = rule.when(rows > bound, F.lit(files))
    return rule.otherwise(F.lit(1))


def output_files_for(rows: int) -> int | None:
    """``output_files`` for a number known to the driver."""
    if rows <= 0:
        return None
    return next((files for bound, files in FILE_RULE if rows > bound), 1)
