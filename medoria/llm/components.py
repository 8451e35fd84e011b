"""Connected components of an undirected graph given as an edge table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from medoria.work import materialise


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """Hang the neighbours of every node on the smallest one: those above the node, or those below it."""
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    if large:
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        joined = both.where("v > u").join(least, "u")
        out = joined.select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        below = both.where("v < u")
        least = below.groupBy("u").agg(F.min("v").alias("m"))
        joined = below.join(least, "u")
        out = joined.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(
            least.select("u", F.col("m").alias("v"))
        )
    return out.where("u <> v").distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, root) of all nodes with an edge; the root is the smallest node of the component.

    ``edges`` has two columns of one type, u and v. Large-star and small-star steps
    alternate until nothing changes; each round is a written table, the driver sees a
    count and a checksum. Loops (u = v) are dropped; nodes without other edges have no row.
    """
    edges = materialise(edges.where("u <> v").select("u", "v").distinct(), "edges")
    before = None
    while True:
        edges = materialise(_star(_star(edges, large=True), large=False), "edges")
        state = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == before:
            break
        before = state
    members = edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return members.unionByName(members.select(F.col("root").alias("node"), "root").distinct())
