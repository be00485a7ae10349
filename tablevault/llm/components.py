"""Connected components of links between 64-bit nodes, without a driver-side graph."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablevault.llm.common import release, stored

_MOST_ROUNDS = 60


def components(links: DataFrame) -> DataFrame:
    """(node, component) for all nodes of `links` (columns u and v), component the least node.

    Rounds of two steps: every node's larger neighbours are linked to the least neighbour
    (or the node itself), then every node's smaller neighbours are. Each step keeps
    components whole and makes them flatter, until each is a star around its least node. A node with very many links is a partial aggregation
    and a join that adaptive execution may split. Rounds end up in the shared folder.
    """
    edges = stored(
        links.where("u <> v")
        .select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
        .distinct(),
        "links",
    )
    for _ in range(_MOST_ROUNDS):
        if _are_stars(edges):
            break
        edges = stored(_small_star(_large_star(edges)), "links")
        release(edges.sparkSession)
    else:
        raise RuntimeError(f"components did not settle in {_MOST_ROUNDS} rounds")
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
        edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    )


def _are_stars(edges: DataFrame) -> bool:
    """Whether every node has one link to a lesser node, which has none, or links to greater ones."""
    ends = edges.select(F.col("u").alias("node"), F.lit(1).alias("below")).unionByName(
        edges.select(F.col("v").alias("node"), F.lit(0).alias("below"))
    )
    nodes = ends.groupBy("node").agg(F.sum("below").alias("below"), F.min("below").alias("least"))
    return nodes.where("below > 1 OR (below = 1 AND least = 0)").isEmpty()


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    return (
        both.where("v > u")
        .join(least, "u")
        .select(F.col("v").alias("u"), F.col("m").alias("v"))
        .distinct()
    )


def _small_star(edges: DataFrame) -> DataFrame:
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    moved = edges.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionByName(least.select("u", F.col("m").alias("v"))).distinct()
