"""Connected components of a graph whose edges lie in a DataFrame.

Each round hooks every node to its smallest neighbour, follows the hooks to their roots
by doubling, and contracts the graph to its roots.  Nodes more than halve per round, and
every step is a join or an aggregate of slim rows, cut by a written table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loanlens.llm.store import written


def _roots(hooks: DataFrame) -> DataFrame:
    """(node, root) from (node, up) by pointer doubling; a node above all others is not in ``hooks``."""
    at = written(hooks.select("node", F.col("up").alias("root")), "hooks")
    while True:
        up = at.select(F.col("node").alias("root"), F.col("root").alias("next"))
        step = written(at.join(up, "root", "left").select("node", F.coalesce("next", "root").alias("root"),
                                                          F.col("next").isNotNull().alias("moved")), "hooks")
        at = step.select("node", "root")
        if step.where("moved").isEmpty():
            return at


def components(edges: DataFrame) -> DataFrame:
    """(node, component) of all nodes of ``edges`` (u, v); the component is its smallest node.

    Loops and repeated edges are allowed; null ends are dropped.
    """
    edges = written(edges.where("u <> v").select(F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v")).distinct(), "edges")
    labels = None
    while not edges.isEmpty():
        hooks = edges.groupBy(F.col("v").alias("node")).agg(F.min("u").alias("up"))
        roots = _roots(hooks)
        if labels is None:
            tops = edges.select(F.col("u").alias("node")).distinct().join(roots, "node", "left_anti").select("node", F.col("node").alias("component"))
            labels = written(roots.withColumnRenamed("root", "component").unionByName(tops), "labels")
        else:
            new = roots.select(F.col("node").alias("component"), "root")
            labels = written(labels.join(new, "component", "left").select("node", F.coalesce("root", "component").alias("component")), "labels")
        a = roots.select(F.col("node").alias("u"), F.col("root").alias("ru"))
        b = roots.select(F.col("node").alias("v"), F.col("root").alias("rv"))
        u, v = F.coalesce("ru", "u"), F.coalesce("rv", "v")
        edges = written(edges.join(a, "u", "left").join(b, "v", "left").where(u != v)
                        .select(F.least(u, v).alias("u"), F.greatest(u, v).alias("v")).distinct(), "edges")
    if labels is None:
        return edges.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return labels
