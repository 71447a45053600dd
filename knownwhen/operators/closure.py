"""Connected components of an edge table, by alternating stars.

Every node of a star points to its smallest neighbour, first for larger neighbours, then for
smaller ones; stars merge until each component is one star around its smallest node. The
rounds grow with the logarithm of a component, and no edge is ever multiplied, so a hub
with any number of neighbours costs one row per neighbour. Every round is written to the
shared folder, and one bit of it reaches the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from knownwhen.sources.shared import settle


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component): the smallest node that can be reached from each node of ``edges``.

    Nodes are of any type with an order. Loops make a node its own component, edges with a
    null end say nothing, direction and repeats don't matter.
    """
    x, y = F.col(a), F.col(b)
    known = edges.select(x.alias("x"), y.alias("y")).where("x IS NOT NULL AND y IS NOT NULL")
    known = settle(known.select(F.greatest("x", "y").alias("x"), F.least("x", "y").alias("y"))
                   .distinct(), "closure-edges")
    stars = known.where("x <> y")
    while True:
        stars = settle(_small_star(_large_star(stars)), "closure-stars")
        if _is_forest_of_stars(stars):
            break
    roots = known.select(F.explode(F.array("x", "y")).alias("node")).distinct()
    return roots.join(stars.withColumnRenamed("x", "node"), "node", "left").select(
        "node", F.coalesce("y", "node").alias("component"))


def _large_star(down: DataFrame) -> DataFrame:
    """(x, y) with x > y: the larger neighbours of every node go to its smallest."""
    both = down.union(down.select("y", "x"))
    least = both.groupBy("x").agg(F.least(F.min("y"), F.first("x")).alias("m"))
    return both.where("y > x").join(least, "x").select(
        F.col("y").alias("x"), F.col("m").alias("y")).distinct()


def _small_star(down: DataFrame) -> DataFrame:
    """(x, y) with x > y: a node and its smaller neighbours go to the smallest of them."""
    least = down.groupBy("x").agg(F.min("y").alias("m"))
    others = down.join(least, "x").where("y > m").select(F.col("y").alias("x"), F.col("m").alias("y"))
    return others.union(least).distinct()


def _is_forest_of_stars(down: DataFrame) -> bool:
    """No node has two parents, or is a parent and a child."""
    ends = down.select("x", F.lit(1).alias("child"), F.lit(0).alias("parent")).union(
        down.select("y", F.lit(0), F.lit(1)))
    nodes = ends.groupBy("x").agg(F.sum("child").alias("child"), F.max("parent").alias("parent"))
    return nodes.where("child > 1 OR (child = 1 AND parent = 1)").isEmpty()
