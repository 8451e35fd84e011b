"""Places in any Hadoop file system: their full names, what lies in them, and removal."""

from __future__ import annotations

import re

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession

# scheme and authority of a path
SCHEME = r"^[a-zA-Z][a-zA-Z0-9+.-]*:(//[^/]*)?"


def _system(spark: SparkSession, path: str):
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()), place


def qualified(spark: SparkSession, path: str) -> str:
    """The path with its scheme, absolute; as it is where this session knows no such file system."""
    try:
        system, place = _system(spark, path)
        return system.makeQualified(place).toString().rstrip("/")
    except Py4JJavaError:
        return path.rstrip("/")


def one_spelling(spark: SparkSession, path: str) -> str:
    """One name per place: the s3 schemes are one store, local paths have one scheme."""
    path = re.sub(r"^s3[an]?://", "s3://", path.rstrip("/"))
    if not path.startswith("s3://"):
        path = qualified(spark, path)
    return re.sub(r"^file:/+", "/", path)


def nested(spark: SparkSession, one: str, other: str) -> bool:
    """Whether two places are the same or one lies in the other."""
    a, b = (one_spelling(spark, path) + "/" for path in (one, other))
    return a.startswith(b) or b.startswith(a)


def children(spark: SparkSession, path: str) -> dict[str, bool]:
    """What lies directly in a folder: names, and whether each is a folder; nothing if it is not there."""
    system, place = _system(spark, path)
    if not system.exists(place):
        return {}
    return {status.getPath().getName(): status.isDirectory() for status in system.listStatus(place)}


def remove(spark: SparkSession, path: str) -> None:
    system, place = _system(spark, path)
    system.delete(place, True)


def matching(spark: SparkSession, pattern: str) -> list[str]:
    """The paths a pattern of the file system matches."""
    system, place = _system(spark, pattern)
    return [status.getPath().toString() for status in system.globStatus(place) or ()]


def head(spark: SparkSession, path: str, n: int) -> bytes:
    """The first ``n`` bytes of a file at most, unpacked; no more of it is read."""
    system, place = _system(spark, path)
    packed = spark._jvm.org.apache.hadoop.io.compress.CompressionCodecFactory(spark._jsc.hadoopConfiguration())
    codec = packed.getCodec(place)
    stream = system.open(place)
    try:
        return bytes((codec.createInputStream(stream) if codec else stream).readNBytes(n))
    finally:
        stream.close()


def size(spark: SparkSession, path: str) -> int:
    system, place = _system(spark, path)
    return system.getFileStatus(place).getLen()


def literal(path: str) -> str:
    """A path as a pattern that matches it alone."""
    return re.sub(r"([\\\[\]{}*?])", r"\\\1", path)


def stamp(spark: SparkSession, path: str) -> tuple[tuple[str, int, int], ...]:
    """What a file, or the files directly in a folder, were when last changed: names, lengths, times."""
    system, place = _system(spark, path)
    return tuple(
        sorted((status.getPath().getName(), status.getLen(), status.getModificationTime()) for status in system.listStatus(place))
    )
