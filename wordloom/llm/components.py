"""Connected components of a graph given as edges, as Spark joins."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from wordloom.session import materialize


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """node, root: the smallest node that can be reached, for every node of an edge.

    Each step takes the smallest root among the neighbours and then the root's root, so a
    star takes two steps and a path of n nodes about log n. Steps are stored, and minima
    are combined in the map tasks, so a node with many edges is no hot spot.
    """
    both = edges.select(F.col(a).alias("x"), F.col(b).alias("y"))
    both = materialize(both.unionByName(both.select(F.col("y").alias("x"), F.col("x").alias("y"))).distinct(), "edges")
    roots = materialize(both.select(F.col("x").alias("node")).distinct().withColumn("root", F.col("node")), "roots")
    while True:
        near = both.join(roots, both.y == roots.node).groupBy("x").agg(F.min("root").alias("least"))
        step = roots.join(near, roots.node == near.x).select(
            "node", F.col("root").alias("old"), F.least("root", "least").alias("root"))
        step = materialize(step, "roots")
        up = step.select(F.col("node").alias("up_node"), F.col("root").alias("up"))
        after = materialize(step.join(up, step.root == up.up_node).select(
            "node", "old", F.least("root", "up").alias("root")), "roots")
        roots = after.select("node", "root")
        if after.filter("root <> old").isEmpty():
            return roots
