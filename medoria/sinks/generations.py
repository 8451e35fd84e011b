"""Folders of a gold table: every overwrite is a generation of its own.

A table lies at ``root/name``, its generations below it. Their names sort by the
time they were begun, and a generation is complete when the marker of a finished
write is in it, so the newest complete one can be told from the files alone.
"""

from __future__ import annotations

import time
import uuid

from pyspark.sql import SparkSession

from medoria.files import children, remove

PREFIX = "generation-"
COMPLETE = "_SUCCESS"


def new_generation(folder: str) -> str:
    return f"{folder.rstrip('/')}/{PREFIX}{time.time_ns():020d}-{uuid.uuid4().hex[:8]}"


def generations(spark: SparkSession, folder: str) -> list[str]:
    """The complete generations of a table, oldest first."""
    found = [name for name, is_folder in children(spark, folder).items() if is_folder and name.startswith(PREFIX)]
    paths = [f"{folder.rstrip('/')}/{name}" for name in sorted(found)]
    return [path for path in paths if COMPLETE in children(spark, path)]


def newest(spark: SparkSession, folder: str) -> str | None:
    """Where the files of a table are: its newest complete generation, or the folder itself if it holds files."""
    complete = generations(spark, folder)
    if complete:
        return complete[-1]
    names = children(spark, folder)
    return folder.rstrip("/") if any(not n.startswith((PREFIX, "_", ".")) for n in names) else None


def layout(spark: SparkSession, location: str) -> str | None:
    """The column the files at a place are partitioned by, None if by none; mixed layouts raise."""
    names = [name for name in children(spark, location) if not name.startswith(("_", "."))]
    columns = {name.partition("=")[0] if "=" in name else None for name in names}
    if len(columns) > 1:
        raise ValueError(f"{location} mixes layouts: {sorted(map(str, columns))}")
    return columns.pop() if columns else None


def retire(spark: SparkSession, folder: str, keep: int) -> None:
    """Remove all but the newest ``keep`` complete generations."""
    for path in generations(spark, folder)[:-keep]:
        remove(spark, path)
