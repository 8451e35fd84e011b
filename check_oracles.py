"""Run registered queries beside their SQL in DuckDB: ``check_oracles.py [sf_dir] [name …]``."""

from __future__ import annotations

import math
import os
import sys
import time

import duckdb

from medoria.session import session
from medoria.work import discard_work
from workload.bindings import TABLES
from workload.oracles import ORACLES
from workload.queries import REGISTERED


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"create view {name} as select * from '{sf_dir}/{name}.parquet'")
    return connection


WORK_DIR = os.environ.get("CHECK_WORK_DIR", "/tmp/medoria-check")

# DuckDB and Spark names of the types the outputs may have
TYPES = {
    "BIGINT": "bigint",
    "BOOLEAN": "boolean",
    "DATE": "date",
    "DOUBLE": "double",
    "INTEGER": "int",
    "VARCHAR": "string",
}


def _plain(value):
    if isinstance(value, float):
        return None if math.isnan(value) else value
    return value


def compare(spark, connection, name: str, sf_dir: str) -> str | None:
    """What differs between a query and its SQL; None if nothing."""
    df = REGISTERED[name](spark, sf_dir)
    columns = sorted(df.columns)
    ours = [tuple(_plain(row[c]) for c in columns) for row in df.collect()]
    if name not in ORACLES:
        return None if ours else "no rows"
    result = connection.execute(ORACLES[name])
    names = [d[0] for d in result.description]
    schema = sorted((d[0], TYPES.get(str(d[1]), str(d[1]))) for d in result.description)
    if schema != sorted(df.dtypes):
        return f"schema {sorted(df.dtypes)} / {schema}"
    order = [names.index(c) for c in columns]
    theirs = [tuple(_plain(row[i]) for i in order) for row in result.fetchall()]
    if len(ours) != len(theirs):
        return f"rows {len(ours)} / {len(theirs)}"
    ours, theirs = sorted(ours, key=repr), sorted(theirs, key=repr)
    for a, b in zip(ours, theirs):
        if a != b:
            return f"{columns}: {a} / {b}"
    return None


if __name__ == "__main__":
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    chosen = sys.argv[2:] or list(REGISTERED)
    settings = {
        "spark.sql.shuffle.partitions": "8",
        "spark.ui.enabled": "false",
        "spark.checkpoint.dir": WORK_DIR,
        "spark.sql.warehouse.dir": f"{WORK_DIR}/warehouse",
    }
    spark = session("check", "local[8]", **settings)
    spark.sparkContext.setLogLevel("ERROR")
    connection = connect(sf_dir)
    for name in chosen:
        begin = time.time()
        try:
            problem = compare(spark, connection, name, sf_dir)
        except Exception as error:  # report and go on with the next query
            problem = f"{type(error).__name__}: {str(error)[:1500]}"
        discard_work(spark)
        print(f"{time.time() - begin:7.2f}s  {name:36s} {'ok' if problem is None else problem}", flush=True)
