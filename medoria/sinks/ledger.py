"""What was converted from which state of which source, so that a second run converts what changed alone."""

from __future__ import annotations

import hashlib
import json
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from medoria.files import children
from medoria.sinks.report import FAILED, Outcome

# hidden to readers of the folder around it
FOLDER = "_ledger"
SCHEMA = (
    "table_name string, source_path string, state string, settings string, "
    "status string, n_rows bigint, n_cols int, error string"
)


def settings_of(*values) -> str:
    """A digest of whatever decides how a source is converted."""
    return hashlib.sha256(json.dumps([str(v) for v in values]).encode()).hexdigest()


def _path(target_root: str) -> str:
    return f"{target_root.rstrip('/')}/{FOLDER}"


def latest(spark: SparkSession, target_root: str) -> DataFrame:
    """The last entry of each table."""
    if not children(spark, _path(target_root)):
        return spark.createDataFrame([], SCHEMA)
    entries = spark.read.schema(f"{SCHEMA}, at timestamp").parquet(_path(target_root))
    names = [name for name in entries.columns if name not in ("table_name", "at")]
    last = entries.groupBy("table_name").agg(F.max_by(F.struct(*names), "at").alias("entry"))
    return last.select("table_name", "entry.*")


def add(spark: SparkSession, target_root: str, entries: Sequence[tuple[Outcome, str, str, str]]) -> None:
    """Note outcomes with (source path, state, settings); failures are not kept, so they are tried again."""
    rows = [
        (o.table_name, source, state, settings, o.status, o.n_rows, o.n_cols, o.error)
        for o, source, state, settings in entries
        if o.status != FAILED
    ]
    if rows:
        noted = spark.createDataFrame(rows, SCHEMA).withColumn("at", F.current_timestamp())
        noted.coalesce(1).write.mode("append").parquet(_path(target_root))


def unchanged(spark: SparkSession, manifest: DataFrame, target_root: str) -> dict[str, Outcome]:
    """Outcomes of tables of (table_name, source_path, state, settings) that stand as they are: a row per table."""
    known = manifest.join(latest(spark, target_root), ["table_name", "source_path", "state", "settings"])
    there = children(spark, target_root)
    return {
        row["table_name"]: Outcome(row["table_name"], row["status"], row["n_rows"], row["n_cols"], row["error"])
        for row in known.collect()
        # files that somebody removed have to be made again
        if not row["n_rows"] or there.get(row["target_path"].rstrip("/").rpartition("/")[2])
    }
