"""Row numbers without sending all rows, or all rows of a group, to one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from medoria.operators.lookup import lookup
from medoria.work import materialise

# monotonically_increasing_id() holds the partition in the upper bits and the
# position inside the partition in the lower 33.
_POSITION_BITS = 33


def dense_number(
    df: DataFrame, order_by: Sequence[str], out: str, ties: bool = False
) -> DataFrame:
    """Number all rows 1, 2, 3… in the order of ``order_by`` (NULLs first).

    Rows are range-partitioned and sorted, written with their place, and each
    partition's rows are shifted by the rows of the partitions before it. The
    only table gathered in one place has one row per partition. Writing first
    matters: the bounds of a range partitioning are sampled, so computing it
    a second time could place rows differently.

    ``order_by`` should tell all rows apart. Where it cannot, ``ties`` numbers
    equal rows in the order they are read, and lets them span partitions so
    that a frequent value does not fill one task; ``df`` should then be a scan
    with row-wise steps, which a task that is run again reads as before.
    """
    order = list(order_by)
    if ties:
        df = df.withColumn("_seen", F.monotonically_increasing_id())
        order.append("_seen")
    placed = materialise(
        df.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .drop("_seen")
        .withColumn("_place", F.monotonically_increasing_id()),
        "numbered",
    )
    part = F.shiftright("_place", _POSITION_BITS)
    before = F.sum("_rows").over(
        Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    shifts = materialise(
        placed.groupBy(part.alias("_part"))
        .agg(F.count(F.lit(1)).alias("_rows"))
        .select("_part", (before - F.col("_rows")).alias("_shift")),
        "shifts",
    )
    position = F.col("_place").bitwiseAND(F.lit((1 << _POSITION_BITS) - 1))
    return (
        placed.withColumn("_part", part)
        .join(F.broadcast(shifts), "_part")  # one row per partition
        .withColumn(out, F.col("_shift") + position + 1)
        .drop("_part", "_place", "_shift")
    )


def number_within(
    df: DataFrame, group_by: Sequence[str], order_by: Sequence[str], out: str
) -> DataFrame:
    """Number the rows of each group 1, 2, 3… in the order of ``order_by``.

    All rows are numbered once by group and order; the number inside the group
    is the distance to the group's first row. Group columns must not be NULL,
    and ``order_by`` must tell the rows of a group apart.
    """
    numbered = dense_number(df, [*group_by, *order_by], "_number")
    group = F.struct(*group_by)
    first = numbered.groupBy(group.alias("_group")).agg(F.min("_number").alias("_first"))
    return (
        lookup(numbered.withColumn("_group", group), first, "_group", spread_by="_number")
        .withColumn(out, F.col("_number") - F.col("_first") + 1)
        .drop("_group", "_number", "_first")
    )
