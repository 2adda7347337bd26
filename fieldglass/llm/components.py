"""Connected components of an edge table, entirely in DataFrames."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldglass.session import cut


def components(edges: DataFrame, rounds: int = 50) -> DataFrame:
    """(node, root) for all nodes of edges (a, b): root is the least node of the component.

    Every round each node takes the least root among its neighbours and then
    its root's root, so long chains shrink by doubling. Rounds end when nothing
    changes; lineage is cut by checkpoints. Self-edges are fine, edges with a
    null end are ignored, no edges give no rows.
    """
    edges = edges.select("a", "b").dropna()
    both = cut(edges.union(edges.select("b", "a")).union(edges.select("a", "a")).union(edges.select("b", "b")).distinct())
    labels = cut(both.groupBy("a").agg(F.min("b").alias("root")).withColumnRenamed("a", "node"))
    for _ in range(rounds):
        spread = both.join(labels, both.b == labels.node).groupBy("a").agg(F.min("root").alias("root"))
        jump = labels.select(F.col("node").alias("root"), F.col("root").alias("top"))
        new = cut(spread.join(jump, "root", "left").select(F.col("a").alias("node"), F.coalesce(F.least("top", "root"), "root").alias("root")))
        same = new.join(labels.withColumnRenamed("root", "old"), "node").filter("root <> old").isEmpty()
        labels = new
        if same:
            return labels
    raise RuntimeError("components did not settle")


def forest_roots(parents: DataFrame, rounds: int = 50) -> DataFrame:
    """(node, root) of a forest given as (node, parent): every node once, roots as their own parents. Paths halve with every round."""
    labels = cut(parents.select("node", F.col("parent").alias("root")))
    for _ in range(rounds):
        up = labels.select(F.col("node").alias("root"), F.col("root").alias("top"))
        new = cut(labels.join(up, "root").select("node", F.col("top").alias("root"), (F.col("top") != F.col("root")).alias("moved")))
        labels = new.select("node", "root")
        if new.filter("moved").isEmpty():
            return labels
    raise RuntimeError("the parents don't form a forest")
