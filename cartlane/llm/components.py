"""Connected components by joins: large and small stars in turn.

A large star hangs every larger neighbour of a node on the node's smallest neighbour, a small
star does so for the smaller ones. Edges only ever get closer to the smallest node of their
component; when every node hangs on one that hangs on nothing, that is it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartlane.llm.shared import dropped, kept


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """``edges`` as ``a > b``. Smallest neighbours are partial minima, so a hub is no large group."""
    there = edges.select(F.col("a").alias("node"), F.col("b").alias("other"))
    near = there.union(edges.select(F.col("b").alias("node"), F.col("a").alias("other"))) if large else there
    least = near.groupBy("node").agg(F.min("other").alias("least"))
    least = least.select("node", F.least("node", "least").alias("least"))
    hung = near.join(least, "node")
    if large:
        moved = hung.filter(F.col("other") > F.col("node")).select(F.col("other").alias("a"), F.col("least").alias("b"))
    else:
        moved = hung.select(F.col("other").alias("a"), F.col("least").alias("b")).union(
            least.select(F.col("node").alias("a"), F.col("least").alias("b"))
        )
    return moved.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()


def _settled(edges: DataFrame) -> bool:
    """Whether every node has one edge downwards, to a node that has none."""
    below = edges.select(F.col("a").alias("node"), F.lit(1).alias("down"), F.lit(0).alias("up"))
    above = edges.select(F.col("b").alias("node"), F.lit(0).alias("down"), F.lit(1).alias("up"))
    nodes = below.union(above).groupBy("node").agg(F.sum("down").alias("down"), F.max("up").alias("up"))
    return nodes.filter("down > 1 OR down + up > 1").agg(F.count(F.lit(1)).alias("n")).first()["n"] == 0


def connected(links: DataFrame) -> DataFrame:
    """``node, root`` for every node of ``links`` (``a, b``): the smallest node it can reach."""
    edges = links.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    edges = kept(edges, "edges")
    while not _settled(edges):
        larger = kept(_star(edges, large=True), "edges")
        dropped(edges)
        edges = kept(_star(larger, large=False), "edges")
        dropped(larger)
    roots = edges.select(F.col("b").alias("node")).distinct().select("node", F.col("node").alias("root"))
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).union(roots)
