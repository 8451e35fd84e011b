"""What happened to each table of a run."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import astuple, dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

OK, EMPTY, FAILED = "OK", "EMPTY", "FAILED"
REPORT_SCHEMA = "table_name string, status string, n_rows bigint, n_cols int, error string"


@dataclass(frozen=True)
class Outcome:
    table_name: str
    status: str
    n_rows: int | None = None
    n_cols: int | None = None
    error: str | None = None


def as_report(spark: SparkSession, outcomes: Sequence[Outcome]) -> DataFrame:
    return spark.createDataFrame([astuple(outcome) for outcome in outcomes], REPORT_SCHEMA)


def summary(report: DataFrame) -> DataFrame:
    """Totals of a report and the share of tables that are OK, in percent."""
    ok = (F.col("status") == OK).cast("int")
    return report.agg(
        F.count(F.lit(1)).alias("total"),
        *[
            F.sum((F.col("status") == status).cast("int")).cast("bigint").alias(status.lower())
            for status in (OK, EMPTY, FAILED)
        ],
        F.round(F.avg(ok) * 100, 1).alias("success_rate"),
    )


def failed(outcomes: Sequence[Outcome]) -> bool:
    """Whether the run as a whole failed; empty tables are no failure."""
    return any(outcome.status == FAILED for outcome in outcomes)
