"""Connected components by alternating large-star and small-star steps.

Large-star links every larger neighbour of a node to the smallest of its neighbourhood;
small-star does so with the node and its smaller neighbours.  The edges turn into stars around
the smallest node of each component.  A step is an aggregate (which folds a hub's edges in each
task before the shuffle) and a join of slim rows; each pair of steps is cut by a written table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loanlens.llm.store import dropped, written


def _large(edges: DataFrame) -> DataFrame:
    """(v, m) for each neighbour v > u of each node u, m the smallest of u and its neighbours."""
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    return both.where("v > u").join(least, "u").select(F.col("m").alias("u"), "v")


def _small(edges: DataFrame) -> DataFrame:
    """Edges hold u < v: of each v its smaller neighbours u and v itself are linked to the smallest of them."""
    least = edges.groupBy("v").agg(F.min("u").alias("m"))
    up = edges.join(least, "v").select(F.col("m").alias("u"), F.col("u").alias("v"))
    return up.unionByName(least.select(F.col("m").alias("u"), "v"))


def components(edges: DataFrame) -> DataFrame:
    """(node, component) of all nodes of ``edges`` (u, v, whole numbers); the component is its smallest node.

    Loops and repeated edges are allowed; null ends are dropped.
    """

    def tidy(e: DataFrame) -> DataFrame:
        return written(e.where("u <> v").select(F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v")).distinct(), "star")

    def state(e: DataFrame):
        key = F.xxhash64("u", "v")
        return tuple(e.agg(F.count(F.lit(1)), F.sum(F.shiftright(key, 24)), F.bit_xor(key)).first())

    at = tidy(edges)
    before = state(at)
    while before[0]:
        step = tidy(_small(_large(at)))
        dropped(at)
        at, after = step, state(step)
        if after == before:
            break
        before = after
    tops = at.select(F.col("u").alias("node"), F.col("u").alias("component")).distinct()
    return written(at.select(F.col("v").alias("node"), F.col("u").alias("component")).unionByName(tops), "labels")
