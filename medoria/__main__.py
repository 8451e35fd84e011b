"""Run the pipeline: ``python -m medoria --source DIR --output DIR``."""

from __future__ import annotations

import argparse
import datetime as dt
import sys

from medoria.config import Settings
from medoria.plans.pipeline import STEPS, run_pipeline
from medoria.session import session
from medoria.sinks import as_report, failed, summary
from medoria.work import discard_work


def main(argv: list[str] | None = None) -> int:
    parser = argparse.ArgumentParser(prog="medoria", description=__doc__)
    parser.add_argument("--source", dest="source_root", help="folder of raw files")
    parser.add_argument("--output", dest="output_root", help="folder for silver and gold")
    parser.add_argument("--format", dest="file_format", help="csv, json or parquet")
    parser.add_argument("--database", help="database of the star")
    parser.add_argument("--table-format", dest="table_format", help="format of the gold tables")
    parser.add_argument("--as-of", dest="as_of", type=dt.date.fromisoformat, help="day ages refer to")
    parser.add_argument("--survey-year", dest="survey_year", type=int)
    parser.add_argument("--relocate-to", dest="relocate_to", help="move the star there when built")
    parser.add_argument("--keep-generations", dest="keep_generations", type=int, help="contents kept per gold table")
    parser.add_argument("--output-files", dest="output_files", action="store_true", default=None, help="size silver by its rows")
    parser.add_argument("--changed-only", dest="changed_only", action="store_true", default=None, help="convert changed sources alone")
    parser.add_argument("--hive", action="store_true", help="use the metastore the session is set up with")
    parser.add_argument("--steps", nargs="+", choices=list(STEPS), default=list(STEPS))
    given = {k: v for k, v in vars(parser.parse_args(argv)).items() if v is not None}
    steps, hive = given.pop("steps"), given.pop("hive")

    spark = session(hive=hive)
    report = run_pipeline(spark, Settings.from_env(**given), steps)
    outcomes = [outcome for _, outcome in report]
    as_report(spark, outcomes).show(len(outcomes) or 1, truncate=False)
    summary(as_report(spark, outcomes)).show()
    discard_work(spark)
    return 1 if failed(outcomes) else 0


if __name__ == "__main__":
    sys.exit(main())
