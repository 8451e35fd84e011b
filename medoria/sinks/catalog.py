"""External tables in the catalog of the session."""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from medoria.files import one_spelling
from medoria.sinks.generations import layout, new_generation, newest
from medoria.sinks.report import EMPTY, FAILED, OK, Outcome
from medoria.specs import STAR, TableSpec


def ensure_database(spark: SparkSession, database: str, location: str | None = None) -> None:
    where = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{database}`{where}")


def _columns(schema: StructType) -> str:
    return ", ".join(f"`{field.name}` {field.dataType.simpleString()}" for field in schema)


def register(
    spark: SparkSession,
    database: str,
    name: str,
    location: str,
    schema: StructType,
    partition_by: Sequence[str] = (),
    table_format: str = "parquet",
) -> bool:
    """Register the files at ``location`` if no table has the name; whether it did.

    The schema is declared, not inferred, so an empty or partitioned table
    keeps its types.
    """
    table = f"`{database}`.`{name}`"
    if spark.catalog.tableExists(f"{database}.{name}"):
        return False
    layout = f" PARTITIONED BY ({', '.join(f'`{c}`' for c in partition_by)})" if partition_by else ""
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {table} ({_columns(schema)}) "
        f"USING {table_format}{layout} LOCATION '{location}'"
    )
    if partition_by and table_format == "parquet":
        spark.catalog.recoverPartitions(f"{database}.{name}")
    return True


def create_if_absent(
    spark: SparkSession, database: str, spec: TableSpec, root: str, table_format: str = "parquet"
) -> bool:
    """Create the declared table empty, unless there is one; whether it did.

    Files that are there already stay and become the content of the table.
    """
    if spark.catalog.tableExists(f"{database}.{spec.name}"):
        return False
    folder = f"{root.rstrip('/')}/{spec.name}"
    location = newest(spark, folder)
    if location is None:
        location, partitions = new_generation(folder), list(spec.declared_by)
        empty = spark.createDataFrame([], spec.schema)
        empty.write.format(table_format).mode("errorifexists").partitionBy(*partitions).save(location)
    else:
        column = layout(spark, location)
        partitions = [column] if column else []
    return register(spark, database, spec.name, location, spec.schema, partitions, table_format)


def register_all(
    spark: SparkSession,
    database: str,
    locations: Mapping[str, str],
    table_format: str = "parquet",
) -> list[Outcome]:
    """Enter tables of the star from their files alone.

    A location is the folder of a table: its newest complete generation is
    entered, or the files in it. An entry that points elsewhere is moved there.
    Tables without rows are EMPTY, those without files or with mixed layouts FAILED.
    """
    outcomes = []
    for name, folder in locations.items():
        spec = STAR[name]
        try:
            location = newest(spark, folder)
            if location is None:
                raise FileNotFoundError(f"no files of {name} at {folder}")
            column = layout(spark, location)
            partitions = [column] if column else []
            files = spark.read.format(table_format).schema(spec.schema).load(location)
            rows = files.count()  # from the footers
            table = f"{database}.{name}"
            known = spark.catalog.tableExists(table) and location_of(spark, database, name)
            if not known or one_spelling(spark, known) != one_spelling(spark, location):
                move_entry(spark, database, name, location, spec.schema, partitions, table_format)
        except (PySparkException, Py4JJavaError, OSError, ValueError) as error:
            outcomes.append(Outcome(name, FAILED, error=str(error)))
        else:
            outcomes.append(Outcome(name, OK if rows else EMPTY, rows, len(spec.schema)))
    return outcomes


def location_of(spark: SparkSession, database: str, name: str) -> str:
    """Where the files of a registered table are."""
    details = spark.sql(f"DESCRIBE FORMATTED `{database}`.`{name}`")
    return details.where("col_name = 'Location'").first()["data_type"]


def move_entry(
    spark: SparkSession,
    database: str,
    name: str,
    location: str,
    schema: StructType,
    partition_by: Sequence[str] = (),
    table_format: str = "parquet",
) -> None:
    """Point the entry at other files; those it pointed at before stay.

    Between layouts without partitions this is one step. Partitions have
    locations of their own, so a table that has or gets them is entered under
    another name first, and takes the old one's place when that worked.
    """
    table = f"{database}.{name}"
    if spark.catalog.tableExists(table):
        columns = spark.catalog.listColumns(table)
        plain = not partition_by and not any(column.isPartition for column in columns)
        if plain and [column.name for column in columns] == schema.names:
            spark.sql(f"ALTER TABLE `{database}`.`{name}` SET LOCATION '{location}'")
            spark.catalog.refreshTable(table)
            return
        entered = f"{name}_{uuid.uuid4().hex[:8]}"
        register(spark, database, entered, location, schema, partition_by, table_format)
        spark.sql(f"DROP TABLE `{database}`.`{name}`")
        spark.sql(f"ALTER TABLE `{database}`.`{entered}` RENAME TO `{database}`.`{name}`")
        spark.catalog.refreshTable(table)
        return
    register(spark, database, name, location, schema, partition_by, table_format)


def databases(spark: SparkSession) -> DataFrame:
    return spark.sql("SHOW DATABASES")


def tables_in(spark: SparkSession, database: str) -> DataFrame:
    """The tables of a database, without the temporary views of the session."""
    return spark.sql(f"SHOW TABLES IN `{database}`").where("not isTemporary")
