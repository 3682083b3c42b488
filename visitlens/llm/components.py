"""Connected components by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from visitlens.llm.scratch import save


def _least(edges: DataFrame) -> DataFrame:
    """(u, least): the smallest neighbour of each node. Counted before the shuffle,
    and written, so that a node with very many edges can be split in the join."""
    return save(edges.groupBy("u").agg(F.min("v").alias("least")))


def _large_star(edges: DataFrame) -> DataFrame:
    """Each node links its larger neighbours to the smallest node it sees."""
    both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = _least(both)
    return (
        both.join(least, "u")
        .where(F.col("v") > F.col("u"))
        .select(F.col("v").alias("u"), F.least("u", "least").alias("v"))
    )


def _small_star(edges: DataFrame) -> DataFrame:
    """Each node links itself and its smaller neighbours to the smallest of them."""
    least = _least(edges)
    moved = edges.join(least, "u").where(F.col("v") != F.col("least"))
    return moved.select(F.col("v").alias("u"), F.col("least").alias("v")).union(
        least.select("u", F.col("least").alias("v"))
    )


def _is_star(edges: DataFrame) -> bool:
    """True if each smaller end is the end of no other edge."""
    ends = edges.select(F.col("u").alias("node"), F.lit(1).alias("up"), F.lit(0).alias("down"))
    ends = ends.union(edges.select("v", F.lit(0), F.lit(1)))
    mixed = (
        ends.groupBy("node").agg(F.sum("up").alias("up"), F.max("down").alias("down"))
        .where("up + down > 1")
    )
    return mixed.isEmpty()


def connected_components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component): every node of a link and the smallest node it reaches.

    Links have no direction; repeated ones and those of a node with itself are
    ignored. Rows with a null end are ignored. No links give an empty table.
    """
    edges = save(
        links.where(F.col(a) != F.col(b))
        .select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
        .distinct()
    )
    while not _is_star(edges):
        edges = save(_small_star(save(_large_star(edges))).distinct())
    roots = edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).union(roots)
