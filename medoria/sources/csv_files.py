"""Raw CSV: the layout of every file from its first bytes, columns by name, broken records kept."""

from __future__ import annotations

import csv
import datetime as dt
import re
from collections.abc import Collection, Mapping, Sequence
from functools import reduce
from urllib.parse import unquote

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, DataFrameReader, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (
    DataType,
    DateType,
    DoubleType,
    IntegerType,
    LongType,
    NumericType,
    StringType,
    StructField,
    StructType,
)

from medoria.files import head, literal
from medoria.parallel import together

# How raw CSV files are written.
CSV_OPTIONS = {
    "header": True,
    "quote": '"',
    "escape": '"',
    "encoding": "UTF-8",
    "multiLine": False,
    "ignoreLeadingWhiteSpace": True,
    "ignoreTrailingWhiteSpace": True,
}
SEPARATORS = (",", ";")
UNREADABLE = "�"  # what a byte that is not UTF-8 decodes to
CORRUPT = "_corrupt_record"  # as Spark names it
HEAD_BYTES = 64 * 1024
HEADS_AT_ONCE = 16
GUESSED_FROM = 16  # files whose beginnings a guess of types is made from
# what only typed values need; text is read without it
TYPE_OPTIONS = {"dateformat", "timestampformat", "timestampntzformat", "locale"}

Layout = tuple[str, tuple[str, ...]]


def sniff_separator(first_lines: Sequence[str]) -> str:
    """``;`` if the first two lines hold more of it than ``,`` or are not UTF-8, else ``,``."""
    lines = "".join(first_lines[:2])
    if UNREADABLE in lines or lines.count(";") > lines.count(","):
        return ";"
    return ","


def files_of(spark: SparkSession, path: str) -> list[str]:
    """The files of a source, by name; the listing alone, without a job."""
    listed = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
    return sorted(unquote(name) for name in listed.inputFiles())


def first_lines(start: bytes, whole: bool) -> list[str]:
    """The lines of the beginning of a file that are not blank, without the last if it is cut off and not the only one."""
    lines = start.decode("utf-8", "replace").removeprefix("﻿").splitlines()
    if not whole and len(lines) > 1:
        lines.pop()
    elif not whole and lines:
        lines[0] = lines[0].rstrip(UNREADABLE)  # the bytes end inside a character
    return [line for line in lines if line.strip()]


def _cells(line: str, separator: str) -> tuple[str, ...]:
    found = next(csv.reader([line], delimiter=separator, skipinitialspace=True, strict=False), [])
    return tuple(cell.strip() for cell in found)


def layout(lines: Sequence[str]) -> Layout | None:
    """Separator and header of a file from its first lines; None if it has none."""
    if not lines:
        return None
    separator = sniff_separator(lines)
    other = next(s for s in SEPARATORS if s != separator)
    # a wrong guess leaves the header in one piece
    if separator not in lines[0] and other in lines[0] and len(_cells(lines[0], other)) > 1:
        separator = other
    return separator, _cells(lines[0], separator)


def layouts(spark: SparkSession, path: str) -> dict[Layout, list[str]]:
    """The files of a source by their layout; of each file its beginning is read."""

    def of(name: str) -> Layout | None:
        start = head(spark, name, HEAD_BYTES)
        return layout(first_lines(start, len(start) < HEAD_BYTES))

    names = files_of(spark, path)
    by: dict[Layout, list[str]] = {}
    for name, found in zip(names, together(of, names, HEADS_AT_ONCE)):
        if found is not None:
            by.setdefault(found, []).append(name)
    return by


# beginnings of records as Spark splits them, without anything that quotes or escapes
_PLAIN_LINE = re.compile(r"[ !#-~]+")
_WHOLE = re.compile(r"-?[0-9]{1,18}")
_FRACTION = re.compile(r"-?[0-9]{1,15}\.[0-9]{1,15}")
_DAY = re.compile(r"[0-9]{4}-[0-9]{2}-[0-9]{2}")
_WORD = re.compile(r"[A-Za-z]{2}.*")
_NO_WORDS = {"true", "false", "nan", "inf", "infinity", "null", "epoch", "now", "today", "tomorrow", "yesterday"}


def _is_day(cell: str) -> bool:
    try:
        return _DAY.fullmatch(cell) is not None and dt.date.fromisoformat(cell) is not None
    except ValueError:
        return False


def _guessed_type(cells: Collection[str]) -> DataType | None:
    """The type that inference gives a column with these values if all others fit it too; None if that is not sure.

    A column of which nothing is known, numbers beyond 64 bits, times and truth values are left to inference.
    """
    cells = {cell for cell in cells if cell}
    if any(_WORD.fullmatch(cell) and cell.lower() not in _NO_WORDS for cell in cells):
        return StringType()  # whatever the others are
    if not cells:
        return None
    if all(_is_day(cell) for cell in cells):
        return DateType()
    if all(_WHOLE.fullmatch(cell) for cell in cells):
        return IntegerType() if all(-(2**31) <= int(cell) < 2**31 for cell in cells) else LongType()
    if all(_WHOLE.fullmatch(cell) or _FRACTION.fullmatch(cell) for cell in cells):
        return DoubleType()
    return None


def read_csv_as_begun(spark: SparkSession, path: str, text_columns: Collection[str] = ()) -> DataFrame | None:
    """What ``read_csv`` reads with ``keep_corrupt``, with types told from the beginnings of the files and no pass to infer them.

    That is a guess, and reading proves it: a record that is broken, or holds a value of another type, has its
    text in ``_corrupt_record``. If not one record has, the rows and types are those of ``read_csv``; else the
    types are not known and the frame is of no use. None if the beginnings do not tell every type for sure.
    """
    if str(spark.conf.get("spark.sql.legacy.timeParserPolicy")).upper() == "LEGACY":
        return None
    names = files_of(spark, path)
    chosen = set(names[:: max(1, len(names) // GUESSED_FROM)])

    def look(name: str) -> tuple[Layout, list[str]] | None:
        start = head(spark, name, HEAD_BYTES)
        whole = len(start) < HEAD_BYTES
        found = layout(first_lines(start, whole))
        if found is None or name not in chosen:
            return found and (found, [])
        records = re.split(r"\r\n|\r|\n", start.decode("utf-8", "replace"))[1 : None if whole else -1]
        return found, [record for record in records if _PLAIN_LINE.fullmatch(record)]

    looked = [one for one in together(look, names, HEADS_AT_ONCE) if one is not None]
    if len({found for found, _ in looked}) != 1:
        return None
    separator, header = looked[0][0]
    reader = spark.read.options(**CSV_OPTIONS, recursiveFileLookup=True)
    columns = reader.csv(path, sep=separator).schema.names
    if len(columns) != len(header) or CORRUPT in (c.lower() for c in columns):
        return None

    cut = [[cell.strip() for cell in record.split(separator)] for _, records in looked for record in records]
    rows = [cells for cells in cut if len(cells) == len(columns) and cells != list(header)]
    text = set(text_columns)
    types = [StringType() if c in text else _guessed_type({cells[k] for cells in rows}) for k, c in enumerate(columns)]
    if None in types:
        return None

    # days are read as text: the reader's way to parse them takes as long as all else it does
    fields = [StructField(c, StringType() if t == DateType() else t) for c, t in zip(columns, types)]
    plain = reader.schema(StructType([*fields, StructField(CORRUPT, StringType())])).option("columnNameOfCorruptRecord", CORRUPT)
    raw = plain.csv(path, sep=separator)
    values = {c: F.col("`" + c.replace("`", "``") + "`") for c in columns}
    days = {c: values[c] for c, t in zip(columns, types) if t == DateType()}
    # what a cast takes and a day written in full is not, such as a year alone, is another type to inference
    strange = [F.when(~day.eqNullSafe(day.try_cast("date").cast("string")), day) for day in days.values()]
    return raw.select(
        *[days[c].try_cast("date").alias(c) if c in days else values[c] for c in columns],
        F.coalesce(CORRUPT, *strange).alias(CORRUPT),
    )


def _wider(one: DataType, other: DataType) -> DataType:
    """A type that holds the values of both; text if there is no other."""
    if one == other:
        return one
    if isinstance(one, NumericType) and isinstance(other, NumericType):
        whole = {"tinyint": 1, "smallint": 2, "int": 4, "bigint": 8}
        a, b = whole.get(one.simpleString()), whole.get(other.simpleString())
        return (one if a >= b else other) if a and b else DoubleType()
    return StringType()


def _columns(
    reader: DataFrameReader, as_text: DataFrameReader, files: list[str] | str, separator: str, text: set[str]
) -> list[StructField]:
    """The columns of files with one header, with the types of their values unless they are text."""
    plain = as_text.csv(files, sep=separator).schema
    if {f.name for f in plain} <= text:
        return list(plain)
    try:
        found = reader.csv(files, sep=separator, inferSchema=True).schema
    except (PySparkException, Py4JJavaError):
        # without inference every column is text; an unreadable source fails here
        return list(plain)
    return [StructField(f.name, StringType()) if f.name in text else f for f in found]


def _known(header: Sequence[str], schema: StructType) -> list[StructField]:
    """The columns of a header with the types of a schema, by name; by place if no name is known."""
    types = {f.name.lower(): f for f in schema}
    if not any(cell.lower() in types for cell in header):
        return list(schema)
    return [types.get(cell.lower(), StructField(cell or f"_c{k}", StringType())) for k, cell in enumerate(header)]


def read_csv(
    spark: SparkSession,
    path: str,
    schema: StructType | None = None,
    text_columns: Collection[str] = (),
    keep_corrupt: bool = False,
    options: Mapping[str, str] | None = None,
) -> DataFrame:
    """CSV with a header, the separator of each file found out and its types inferred.

    Files of one separator and header are read together; those of several are merged by
    the names of their columns, and what a file has no column for is missing. A column
    whose files have different numbers is as wide as the widest, one of different types is text.

    Inference reads the files once more; a known ``schema`` avoids that, and so
    do ``text_columns`` where they are all there is. Columns of that name are
    text, whatever their values look like: a code keeps its leading zeros.
    If types cannot be inferred every column is text. ``options`` are further ones of Spark's reader.

    A record with more or fewer cells than its header, or a value that a known type does
    not hold, is broken. With ``keep_corrupt`` its text is in ``_corrupt_record``.
    """
    given = {**CSV_OPTIONS, "recursiveFileLookup": True, **(options or {})}
    reader = spark.read.options(**given)
    as_text = spark.read.options(**{k: v for k, v in given.items() if k.lower() not in TYPE_OPTIONS})
    text = set(text_columns)
    by = sorted(layouts(spark, path).items()) or [((SEPARATORS[0], ()), [])]
    # a source of one layout is read by its own path, and listed once more by Spark alone
    groups = [(separator, header, [literal(f) for f in files] if len(by) > 1 else path) for (separator, header), files in by]
    found = [
        _columns(reader, as_text, files, separator, text) if schema is None else _known(header, schema)
        for separator, header, files in groups
    ]
    types: dict[str, DataType] = {}
    for columns in found:
        for f in columns:
            types[f.name.lower()] = _wider(types.get(f.name.lower(), f.dataType), f.dataType)
    corrupt = keep_corrupt and CORRUPT not in types

    def typed(group: tuple[str, tuple[str, ...], list[str] | str], columns: list[StructField]) -> DataFrame:
        fields = [StructField(f.name, types[f.name.lower()]) for f in columns]
        if corrupt:
            fields.append(StructField(CORRUPT, StringType()))
        plain = all(f.dataType == StringType() for f in fields)
        return (as_text if plain else reader).schema(StructType(fields)).option("columnNameOfCorruptRecord", CORRUPT).csv(group[2], sep=group[0])

    merged = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), map(typed, groups, found))
    names = list(schema.names) if schema is not None else [c for c in merged.columns if c != CORRUPT]
    missing = [F.lit(None).cast(schema[n].dataType).alias(n) for n in names if n.lower() not in types] if schema is not None else []
    if schema is not None and (missing or len(names) < len(types)):
        have = [F.col(f"`{n}`") for n in names if n.lower() in types]
        merged = merged.select(*have, *missing, *([CORRUPT] if corrupt else [])).select(*names, *([CORRUPT] if corrupt else []))
    elif corrupt and merged.columns[-1] != CORRUPT:
        merged = merged.select(*names, CORRUPT)
    return merged
