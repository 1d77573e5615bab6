"""Connected components of an edge table by alternating star contractions."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from secflow.llm.common import drop, pinned


def _neighbours(edges: DataFrame) -> DataFrame:
    """Every edge with its node's smallest neighbour, and whether it is the first of equal edges."""
    # From the smallest neighbour; of equal edges the one that a step has moved.
    near = Window.partitionBy("u").orderBy("v", F.col("moved").desc())
    return edges.select("u", "v", "moved", F.first("v").over(near).alias("m"),
                        F.lag("v").over(near).alias("before")).filter(
        F.col("before").isNull() | (F.col("before") != F.col("v")))


def _large_star(edges: DataFrame) -> DataFrame:
    """Link every larger neighbour of a node to the smallest of the node and its neighbours."""
    both = edges.select(F.inline(F.array(F.struct("u", "v", "moved"),
                                         F.struct(F.col("v").alias("u"), F.col("u").alias("v"), "moved"))))
    return _neighbours(both).filter(F.col("v") > F.col("u")).select(
        F.col("v").alias("u"), F.least("u", "m").alias("v"), (F.col("moved") | (F.col("m") < F.col("u"))).alias("moved"))


def _small_star(edges: DataFrame) -> DataFrame:
    """Link a node and its smaller neighbours to the smallest of them (edges run from u down to v)."""
    other = F.col("v") != F.col("m")
    return _neighbours(edges).select(F.when(other, F.col("v")).otherwise(F.col("u")).alias("u"),
                                     F.col("m").alias("v"), (F.col("moved") | other).alias("moved"))


def stars(edges: DataFrame, name: str) -> DataFrame:
    """(u, v): each node of a component that is not its smallest, and the smallest.

    ``edges`` has columns u, v of one orderable type, in any order and number.  A round is two shuffles, one for each
    star; each round is written to the shared folder, so lineage stays short, and only two numbers reach the driver.
    A round that moved no edge found stars and left them.
    """
    still = F.lit(False).alias("moved")
    edges, old = edges.filter(F.col("u") != F.col("v")).select(
        F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"), still), None
    while True:
        nxt = pinned(_small_star(_large_star(edges)), name)
        if old is not None:
            drop(old)
        if not nxt.agg(F.max("moved")).first()[0]:
            return nxt.select("u", "v")
        old, edges = nxt, nxt.select("u", "v", still)


def components(edges: DataFrame, name: str) -> DataFrame:
    """(node, label): the smallest node of each component, for nodes that have an edge."""
    found = stars(edges, name)
    return found.select(F.col("u").alias("node"), F.col("v").alias("label")).union(
        found.select(F.col("v").alias("node"), F.col("v").alias("label")).distinct())
