"""Raw JSON: the layout of every file from its first bytes, large arrays cut into records by many tasks."""

from __future__ import annotations

import json
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructType

from medoria.files import head, literal, size
from medoria.parallel import together
from medoria.sources.csv_files import HEAD_BYTES, HEADS_AT_ONCE, files_of, first_lines
from medoria.work import materialise, work_path

LINES, WHOLE, ARRAY = "lines", "whole", "array"
ARRAY_BYTES = 64 * 1024 * 1024  # an array of more is cut into records, of less it is read by one task
SOURCE = "_source_file"


def _is_object(line: str) -> bool:
    line = line.strip()
    if not (line.startswith("{") and line.endswith("}")):
        return False
    try:
        json.loads(line)
    except ValueError:
        return False
    return True


def layout(start: bytes, whole: bool) -> str | None:
    """How a file is laid out, from its first bytes; None if these do not tell.

    A file holds an object on each line if its first line is a whole one; an array or
    an object over several lines if no line is. Else records may be broken.
    """
    lines = first_lines(start, whole)
    objects = [_is_object(line) for line in lines]
    if not lines or objects[0]:
        return LINES
    if lines[0].lstrip().startswith("["):
        return ARRAY
    if not any(objects) and (whole or len(lines) > 1):
        return WHOLE
    return (LINES if sum(objects) * 2 >= len(objects) else WHOLE) if whole else None


def _by_all_lines(spark: SparkSession, files: list[str]) -> dict[str, str]:
    """The layout of files whose first bytes do not tell it: by lines if at least half of all are objects."""
    lines = spark.read.text([literal(f) for f in files]).select(
        F.col("_metadata.file_path").alias("file"), F.trim("value").alias("value")
    )
    whole = F.col("value").rlike(r"(?s)^\{.*\}$") & F.try_parse_json("value").isNotNull()
    share = lines.where("value <> ''").groupBy("file").agg(F.avg(whole.cast("int")).alias("share"))
    found = {row["file"].rpartition("/")[2]: row["share"] for row in share.collect()}  # a number per such file
    return {f: LINES if found.get(f.rpartition("/")[2], 1) >= 0.5 else WHOLE for f in files}


def layouts(spark: SparkSession, path: str) -> dict[str, list[str]]:
    """The files of a source by their layout."""

    def of(name: str) -> str | None:
        start = head(spark, name, HEAD_BYTES)
        return layout(start, len(start) < HEAD_BYTES)

    names = files_of(spark, path)
    found = dict(zip(names, together(of, names, HEADS_AT_ONCE)))
    unknown = [f for f, kind in found.items() if kind is None]
    if unknown:
        found |= _by_all_lines(spark, unknown)
    by: dict[str, list[str]] = {}
    for name, kind in found.items():
        by.setdefault(kind or LINES, []).append(name)
    return by


def _count(text: Column, letters: str) -> Column:
    return F.length(text) - F.length(F.translate(text, letters, ""))


def array_records(spark: SparkSession, files: list[str]) -> DataFrame:
    """(file, record): the elements of JSON arrays, each as a line of text.

    Files are split wherever Spark splits them, and each split into pieces that end with a closing
    brace. Whether a piece begins inside a string, and how deep, follows from all pieces before it:
    every split is summed up for both cases, one row each, the sums of the splits before it
    are added, and the pieces of a split are summed up from there. An element ends where the depth is one again.
    """
    split, order = ["file", "block"], Window.partitionBy("file", "block").orderBy("at")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    earlier = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    pieces = spark.read.option("lineSep", "}").text([literal(f) for f in files]).select(
        F.col("_metadata.file_path").alias("file"),
        (F.col("_metadata.file_block_start") + 0).alias("block"),
        F.monotonically_increasing_id().alias("at"),
        "value",
    )

    def summed(column: str, window) -> Column:
        return F.coalesce(F.sum(column).over(window), F.lit(0))

    # what an escape hides is no quote
    bare = pieces.withColumn("bare", F.regexp_replace("value", r"(?s)\\.", "")).withColumn("quotes", _count(F.col("bare"), '"'))
    bare = bare.withColumn("odd", F.pmod(summed("quotes", before), F.lit(2)))

    def depth(inside: Column) -> Column:
        """What a piece adds to the depth, its closing brace included."""
        text = F.regexp_replace(F.concat(F.when(inside, '"').otherwise(""), "bare"), r'"[^"]*("|$)', "")
        ends_inside = F.pmod(F.col("quotes") + inside.cast("int"), F.lit(2)) == 1
        closing = F.when(ends_inside, 0).otherwise(1)
        return _count(text, "{[") - _count(text, "}]") - closing

    bare = bare.withColumn("if_outside", depth(F.col("odd") == 1)).withColumn("if_inside", depth(F.col("odd") == 0)).drop("bare")
    bare = materialise(bare, "pieces")
    splits = bare.groupBy(*split).agg(
        F.sum("quotes").alias("quotes"), F.sum("if_outside").alias("if_outside"), F.sum("if_inside").alias("if_inside")
    )
    splits = splits.withColumn("opens", F.pmod(summed("quotes", earlier), F.lit(2)))
    splits = splits.withColumn("adds", F.when(F.col("opens") == 1, F.col("if_inside")).otherwise(F.col("if_outside")))
    splits = splits.withColumn("level", summed("adds", earlier)).select(*split, "opens", "level")
    known = bare.join(splits, split)
    known = known.withColumn("adds", F.when(F.col("opens") == 1, F.col("if_inside")).otherwise(F.col("if_outside")))
    known = known.withColumn("deep", F.col("level") + F.sum("adds").over(order))
    outside = F.pmod(F.col("opens") + F.col("odd") + F.col("quotes"), F.lit(2)) == 0
    known = known.withColumn("ends", (outside & (F.col("deep") == 1)).cast("int"))
    known = known.withColumn("own", summed("ends", before))
    known = materialise(known.select(*split, "at", "value", "ends", "own", outside.alias("closed")), "pieces")
    done = known.groupBy(*split).agg(F.sum("ends").alias("ends")).withColumn("done", summed("ends", earlier)).drop("ends")
    # one row per split, so the pieces stay where they are
    numbered = known.join(F.broadcast(done), split).withColumn("number", F.col("done") + F.col("own"))
    # an element: its pieces in order, their braces back in place
    parts = F.array_sort(F.collect_list(F.struct("block", "at", "value")))
    whole = numbered.groupBy("file", "number").agg(parts.alias("parts"), F.max("ends").alias("ends"))
    text = F.array_join(F.transform("parts", lambda p: p["value"]), "}")
    record = F.regexp_replace(F.concat(text, F.lit("}")), r"^[\s,\[]+", "")
    return whole.where("ends = 1").select("file", F.regexp_replace(record, r"[\r\n]+", " ").alias("record"))


def _read_arrays(spark: SparkSession, files: list[str], schema: StructType | None) -> DataFrame:
    """The elements of arrays, read by lines; the file they come from is one of their columns."""
    records = array_records(spark, files)
    source = F.concat(F.lit(f'"{SOURCE}": '), F.to_json(F.array("file")))
    named = F.concat(F.lit("{"), F.regexp_replace(source, r": \[(.*)\]$", ": $1"))
    rest = F.substr("record", F.lit(2))
    line = F.concat(named, F.when(F.trim(rest) == "}", "").otherwise(", "), rest)
    path = work_path(spark, "records")
    records.select(line.alias("value")).write.text(path, compression="gzip")
    reader = spark.read
    if schema is not None:
        reader = reader.schema(StructType([*schema.fields]).add(SOURCE, StringType()))
    return reader.json(path)


def read_json(spark: SparkSession, path: str, schema: StructType | None = None, array_bytes: int = ARRAY_BYTES) -> DataFrame:
    """JSON documents of any layout; nested values stay nested.

    The layout of a file is told from its first 64 KB, from all of it where these do not
    tell. Files with an object on each line are read by lines, which also splits them; an array of
    more than ``array_bytes`` is cut into its elements by many tasks, any other file is read whole,
    by one. What does not parse is in ``_corrupt_record``, as Spark names it. Where arrays
    are cut, the file that a row comes from is in ``_source_file``.
    """
    reader = spark.read.option("recursiveFileLookup", True)
    if schema is not None:
        reader = reader.schema(schema)
    by = layouts(spark, path)
    large = [f for f in by.get(ARRAY, ()) if size(spark, f) > array_bytes]
    whole = sorted({*by.get(ARRAY, ()), *by.get(WHOLE, ())} - {*large})
    lines = by.get(LINES, [])
    if not large and not (lines and whole):
        return reader.json(path, multiLine=bool(whole))
    parts = [reader.json([literal(f) for f in files], multiLine=several) for files, several in ((lines, False), (whole, True)) if files]
    if large:
        cut = _read_arrays(spark, large, schema)
        parts = [p.withColumn(SOURCE, F.input_file_name()) for p in parts] + [cut]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
