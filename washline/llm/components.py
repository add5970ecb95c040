"""Connected components by alternating stars, each round one stored table of edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from washline.llm.common import discard, stage


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of the bigint edges (a, b); root is the least node of its component.

    The large star hangs a node's larger neighbours on its least neighbour, the small star the
    smaller ones; the edges become one star per component in a number of rounds that grows with the
    logarithm of the component.  Edges of a node to itself and rows with nulls are passed over.
    """
    now = stage(edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "edges")
    state = _state(now)
    while state[0]:
        stars = stage(_small_star(_large_star(now)), "edges")
        discard(now)
        before, now, state = state, stars, _state(stars)
        if state == before:
            break
    return now.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(now.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())


def _state(edges: DataFrame) -> tuple[int, int]:
    """Number of the edges and a sum that changes with any of them."""
    row = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
    return row[0], int(row[1] or 0)


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min(F.least("u", "v")).alias("m"))
    return both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    moved = edges.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionByName(least.select("u", F.col("m").alias("v"))).distinct()
