"""Intermediate tables in the shared folder of the cluster."""

from __future__ import annotations

import tempfile
import threading
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

from medoria.files import remove

FOLDER_SETTING = "spark.checkpoint.dir"
_local_roots: dict[str, str] = {}
_scope = threading.local()


def work_root(spark: SparkSession) -> str:
    """The folder named in ``spark.checkpoint.dir``.

    Only a session on one machine may go without, as in a notebook: it gets a
    temporary folder. On a cluster a folder of one machine would be lost with
    it, so that is an error.
    """
    root = spark.conf.get(FOLDER_SETTING, None)
    if not root:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError(f"set {FOLDER_SETTING} to a folder every executor can reach")
        app = spark.sparkContext.applicationId
        if app not in _local_roots:
            _local_roots[app] = tempfile.mkdtemp(prefix="medoria-")
        root = _local_roots[app]
    return root.rstrip("/")


def _own_folder(spark: SparkSession) -> str:
    return f"{work_root(spark)}/{spark.sparkContext.applicationId}"


def work_path(spark: SparkSession, label: str) -> str:
    """A path nobody has used yet."""
    return f"{_own_folder(spark)}/{label}-{uuid.uuid4().hex}"


def discard_work(spark: SparkSession) -> None:
    """Delete the work tables of this application, once nothing reads them any more."""
    remove(spark, _own_folder(spark))


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Work tables that this thread makes inside are removed at the end: their result is written by then."""
    outer, _scope.made = getattr(_scope, "made", None), []
    try:
        yield
    finally:
        made, _scope.made = _scope.made, outer
        for path in made:
            remove(spark, path)


def materialise(df: DataFrame, label: str) -> DataFrame:
    """Write once and read back: cuts the lineage and survives lost executors."""
    spark = df.sparkSession
    path = work_path(spark, label)
    if getattr(_scope, "made", None) is not None:
        _scope.made.append(path)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
