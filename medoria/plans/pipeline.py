"""Whole runs: silver to gold, and everything in order."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession

from medoria.config import Settings
from medoria.parallel import together
from medoria.plans import dimensions, facts
from medoria.plans.silver import convert_folder
from medoria.sinks import (
    create_if_absent,
    ensure_database,
    failed,
    register_all,
    relocate,
    replace_table,
    verify_tables,
)
from medoria.sinks.report import FAILED, OK, Outcome
from medoria.sources import load_silver
from medoria.sources.silver import check_silver
from medoria.specs import STAR
from medoria.work import scratch


ERRORS = (PySparkException, Py4JJavaError, OSError, ValueError, LookupError)


class BuildFailed(RuntimeError):
    """Some gold tables could not be built."""


def create_star(spark: SparkSession, cfg: Settings) -> dict[str, bool]:
    """Declare the star: per table, whether it had to be created."""
    ensure_database(spark, cfg.database, cfg.database_root)

    def create(name: str) -> tuple[str, bool]:
        return name, create_if_absent(
            spark, cfg.database, STAR[name], cfg.gold_root, cfg.table_format
        )

    return dict(together(create, STAR))


def build_star(
    spark: SparkSession, t: Mapping[str, DataFrame], cfg: Settings
) -> tuple[dict[str, DataFrame], list[Outcome]]:
    """Write all gold tables that can be built, and what happened to each.

    Facts refer to the dimensions as written; a fact whose dimension failed fails too.
    """
    check_silver(t)
    ensure_database(spark, cfg.database, cfg.database_root)
    gold: dict[str, DataFrame] = {}

    def write(build: tuple[str, tuple[str, ...], Callable[[], DataFrame]]) -> Outcome:
        name, needs, df = build
        absent = [needed for needed in needs if needed not in gold]
        if absent:
            return Outcome(name, FAILED, error=f"{', '.join(absent)} failed")
        try:
            with scratch(spark):
                gold[name] = replace_table(
                    df(), cfg.database, STAR[name], cfg.gold_root, cfg.table_format, cfg.keep_generations
                )
        except ERRORS as error:
            return Outcome(name, FAILED, error=f"{type(error).__name__}: {error}")
        return Outcome(name, OK, n_cols=len(gold[name].columns))

    dims = [
        ("dim_lieu", (), lambda: dimensions.dim_lieu(t)),
        ("dim_patient", (), lambda: dimensions.dim_patient(t, cfg.as_of)),
        ("dim_date", (), lambda: dimensions.dim_date(t, [cfg.survey_year])),
        ("dim_etablissement", (), lambda: dimensions.dim_etablissement(t)),
        ("dim_diagnostic", (), lambda: dimensions.dim_diagnostic(t)),
        ("dim_indicateur", (), lambda: dimensions.dim_indicateur(spark)),
        ("dim_professionel", (), lambda: dimensions.dim_professionel(t)),
    ]
    rows = [
        ("fait_deces", ("dim_lieu",), lambda: facts.fait_deces(t, gold["dim_lieu"])),
        ("fait_hospitalisation", (), lambda: facts.fait_hospitalisation(t)),
        (
            "fait_satisfaction",
            ("dim_etablissement",),
            lambda: facts.fait_satisfaction(t, gold["dim_etablissement"], cfg.survey_year),
        ),
        ("fait_consultations", (), lambda: facts.fait_consultations(t)),
    ]
    outcomes = together(write, dims)
    return gold, outcomes + together(write, rows)


def build_gold(
    spark: SparkSession, t: Mapping[str, DataFrame], cfg: Settings
) -> dict[str, DataFrame]:
    """All gold tables, written; an error that names all that failed."""
    gold, outcomes = build_star(spark, t, cfg)
    broken = [f"{o.table_name}: {o.error}" for o in outcomes if o.status == FAILED]
    if broken:
        raise BuildFailed("; ".join(broken))
    return gold


def register_star(spark: SparkSession, cfg: Settings, root: str | None = None) -> list[Outcome]:
    """Enter the star into the database from the files below a root (that of gold) alone."""
    ensure_database(spark, cfg.database, cfg.database_root)
    root = (root or cfg.gold_root).rstrip("/")
    return register_all(spark, cfg.database, {name: f"{root}/{name}" for name in STAR}, cfg.table_format)


def relocate_star(spark: SparkSession, cfg: Settings, root: str) -> list[Outcome]:
    """Move every table of the star under another root, as it is partitioned now."""

    def move(name: str) -> Outcome:
        try:
            columns = spark.catalog.listColumns(f"{cfg.database}.{name}")
        except ERRORS as error:
            return Outcome(name, FAILED, error=str(error))
        partitions = [column.name for column in columns if column.isPartition]
        target = f"{root.rstrip('/')}/{name}"
        return relocate(spark, cfg.database, name, target, partitions, cfg.table_format)

    # facts first: the small dimensions go on beside them
    moved = {outcome.table_name: outcome for outcome in together(move, reversed(STAR))}
    return [moved[name] for name in STAR]


def _convert(spark: SparkSession, cfg: Settings) -> list[Outcome]:
    return convert_folder(
        spark,
        cfg.source_root,
        cfg.silver_root,
        cfg.file_format,
        output_files=cfg.output_files,
        changed_only=cfg.changed_only,
    )


def _declare(spark: SparkSession, cfg: Settings) -> list[Outcome]:
    create_star(spark, cfg)
    return [Outcome(name, OK, n_cols=len(spec.schema)) for name, spec in STAR.items()]


def _build(spark: SparkSession, cfg: Settings) -> list[Outcome]:
    return build_star(spark, load_silver(spark, cfg.silver_root), cfg)[1]


def _relocate(spark: SparkSession, cfg: Settings) -> list[Outcome]:
    return relocate_star(spark, cfg, cfg.relocate_to) if cfg.relocate_to else []


def _verify(spark: SparkSession, cfg: Settings) -> list[Outcome]:
    counts = verify_tables(spark, cfg.database, STAR).collect()  # one row per table of the star
    return [Outcome(**row.asDict()) for row in counts]


STEPS = {
    "convert": _convert,
    "declare": _declare,
    "build": _build,
    "register": register_star,
    "relocate": _relocate,
    "verify": _verify,
}


def run_pipeline(
    spark: SparkSession, cfg: Settings, steps: Sequence[str] = tuple(STEPS)
) -> list[tuple[str, Outcome]]:
    """Raw files to a registered star, step by step; what happened to each table.

    The run ends after the first step that leaves a failed table, or fails itself:
    its error is reported under the name of the step.
    """
    report: list[tuple[str, Outcome]] = []
    for step in steps:
        try:
            outcomes = STEPS[step](spark, cfg)
        except ERRORS as error:
            outcomes = [Outcome(step, FAILED, error=f"{type(error).__name__}: {error}")]
        report += [(step, outcome) for outcome in outcomes]
        if failed(outcomes):
            break
    return report
