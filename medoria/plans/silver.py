"""Raw files to silver tables."""

from __future__ import annotations

from collections.abc import Mapping

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from medoria.parallel import together
from medoria.sinks.ledger import add, settings_of, unchanged
from medoria.sinks.report import EMPTY, FAILED, OK, Outcome
from medoria.sinks.silver import write_counted
from medoria.sources import UnsupportedFormat, read_raw
from medoria.sources.csv_files import CORRUPT
from medoria.sources.discovery import discover_states, unreadable_names
from medoria.sources.json_files import SOURCE
from medoria.sources.silver import TEXT_COLUMNS


def with_lineage(df: DataFrame, table_name: str) -> DataFrame:
    """When a row was converted, from which file, into which table."""
    file = F.col(SOURCE) if SOURCE in df.columns else F.input_file_name()
    return df.withColumns(
        {
            "conversion_timestamp": F.current_timestamp(),
            "source_file": file,
            "table_name": F.lit(table_name),
        }
    ).drop(SOURCE)


def convert_source(
    spark: SparkSession,
    source_path: str,
    target_path: str,
    table_name: str,
    file_format: str = "csv",
    schema: StructType | None = None,
    output_files: bool = False,
    options: Mapping[str, str] | None = None,
) -> Outcome:
    """One source to one silver table; what goes wrong is in the outcome.

    Records that do not parse are counted as the table is written, and kept in a column of
    their own; a table of CSV files without any has no such column, one with some is written once more to have it.
    CSV files are first written with the types their beginnings tell; if a record does not have
    them, all files are read to infer the types, and the table is written anew.
    """
    try:
        known = TEXT_COLUMNS.get(table_name, ())
        begun = read_raw(spark, source_path, file_format, schema, known, options=options, as_begun=True)
        if begun is not None:
            table = with_lineage(begun, table_name)
            written = write_counted(table, target_path, output_files, [CORRUPT], [CORRUPT])
            if not written.counted[CORRUPT]:
                return Outcome(table_name, OK if written.rows else EMPTY, written.rows, len(table.columns) - 1)
        raw = read_raw(spark, source_path, file_format, schema, known, keep_corrupt=True, options=options)
        table = with_lineage(raw, table_name)
        count = [c for c in table.columns if c == CORRUPT]
        spare = count if file_format.lower() == "csv" else []
        written = write_counted(table, target_path, output_files, count, spare)
        corrupt = written.counted.get(CORRUPT, 0)
        if corrupt and spare:
            written, spare = write_counted(table, target_path, output_files, count), []
    except (PySparkException, Py4JJavaError, UnsupportedFormat) as error:
        return Outcome(table_name, FAILED, error=str(error))
    note = f"{corrupt} records do not parse, they are in {CORRUPT}" if corrupt else None
    return Outcome(table_name, OK if written.rows else EMPTY, written.rows, len(table.columns) - len(spare), note)


def preview(spark: SparkSession, target_path: str, rows: int = 3) -> DataFrame:
    """The first rows of a converted table, to look at."""
    return spark.read.parquet(target_path).limit(rows)


def convert_folder(
    spark: SparkSession,
    source_root: str,
    target_root: str,
    file_format: str = "csv",
    schemas: dict[str, StructType] | None = None,
    output_files: bool = False,
    changed_only: bool = False,
) -> list[Outcome]:
    """Every source under a folder; a broken one does not stop the others.

    Sources that Spark cannot read because of their name are FAILED, not passed over.
    With ``changed_only`` sources whose files are those of an earlier run (by path, length and time of
    change), converted the same way, keep their table and its outcome. Every run is noted for the next one.
    """
    schemas = schemas or {}
    manifest = discover_states(spark, source_root, file_format, target_root).orderBy("table_name")
    rows = manifest.collect()  # one row per table
    how = {
        row["table_name"]: settings_of(
            file_format, schemas.get(row["table_name"]), sorted(TEXT_COLUMNS.get(row["table_name"], ())), output_files
        )
        for row in rows
    }
    kept: dict[str, Outcome] = {}
    if changed_only and rows:
        settings = spark.createDataFrame([*how.items()], "table_name string, settings string")
        kept = unchanged(spark, manifest.join(settings, "table_name"), target_root)

    def convert(entry: Row) -> Outcome:
        if entry["table_name"] in kept:
            return kept[entry["table_name"]]
        return convert_source(
            spark,
            entry["source_path"],
            entry["target_path"],
            entry["table_name"],
            file_format,
            schemas.get(entry["table_name"]),
            output_files,
        )

    # long sources first: the short ones go on beside them
    by_length = sorted(range(len(rows)), key=lambda k: -rows[k]["length"])
    converted = dict(zip(by_length, together(convert, [rows[k] for k in by_length])))
    outcomes = [converted[k] for k in range(len(rows))]
    new = [(o, r["source_path"], r["state"], how[o.table_name]) for o, r in zip(outcomes, rows) if o.table_name not in kept]
    add(spark, target_root, new)
    hidden = unreadable_names(spark, source_root, file_format)
    return outcomes + [Outcome(path, FAILED, error="names that begin with _ or . are hidden to Spark") for path in hidden]
