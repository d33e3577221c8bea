"""Connected components by alternating large-star and small-star rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexmill.operators.scratch import materialized


def _large_star(edges: DataFrame) -> DataFrame:
    """Link every larger neighbour of a node to the smallest one around it."""
    both = edges.union(edges.select("v", "u"))
    least = both.groupBy("u").agg(F.min("v").alias("_m")).select("u", F.least("u", "_m").alias("m"))
    return both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Link the smaller neighbours of a node, and itself, to the smallest one."""
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    moved = down.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.union(least.select("u", F.col("m").alias("v"))).distinct()


def _digest(edges: DataFrame) -> tuple:
    return tuple(edges.agg(
        F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, component): every node that has an edge, with the smallest node it reaches.

    ``edges`` has two columns of one type, whatever their names and direction; nulls,
    loops and repeated rows are dropped.  No edges give no rows.  Minima are
    combined before the shuffle and joins may be split by adaptive execution, so a
    hub with most of the edges is no hot task.  Each round is written to the shared
    folder, so lineage stays short; the rounds grow with the logarithm of the
    longest path.
    """
    a, b = edges.columns
    current = materialized(
        edges.select(F.col(a).alias("u"), F.col(b).alias("v")).where("u <> v")
        .select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct())
    seen = _digest(current)
    while seen[0]:
        current = materialized(_small_star(_large_star(current)))
        now = _digest(current)
        if now == seen:
            break
        seen = now
    roots = current.select(F.col("v").alias("node")).distinct()
    return current.select(F.col("u").alias("node"), F.col("v").alias("component")).union(
        roots.select("node", F.col("node").alias("component")))
