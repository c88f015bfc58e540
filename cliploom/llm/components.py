"""Connected components of an edge table, by hooking to the smallest neighbour and contracting.

Nothing is collected: every round stages its tables in the shared folder. A node without edges is no row; edges with a
null end, and edges of a node to itself, are left out; repeated edges count once; no edges give no rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Workspace


def connected(edges: DataFrame, staged: Workspace) -> DataFrame:
    """edges: a, b (long). Gives node, root: the smallest node that can be reached, itself included. The tables of all
    rounds, and the result, are in the workspace."""
    edges = staged(edges.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "edges")
    labels = None
    while not edges.isEmpty():
        up = staged(edges.groupBy("b").agg(F.min("a").alias("p")).withColumnRenamed("b", "node"), "parents")
        while True:  # every node points at its root after as many rounds as the logarithm of the longest chain
            above = up.select(F.col("node").alias("p"), F.col("p").alias("pp"))
            jumped = staged(up.join(above, "p", "left").select("node", F.coalesce("pp", "p").alias("p"), F.col("pp").isNotNull().alias("moved")), "parents")
            up = jumped.select("node", "p")
            if jumped.where("moved").isEmpty():
                break
        if labels is None:
            nodes = edges.select(F.col("a").alias("node")).unionByName(edges.select(F.col("b").alias("node"))).distinct()
            labels = nodes.join(up, "node", "left").select("node", F.coalesce("p", "node").alias("root"))
        else:
            labels = labels.join(up.withColumnRenamed("node", "root"), "root", "left").select("node", F.coalesce("p", "root").alias("root"))
        labels = staged(labels, "labels")
        a, b = up.select(F.col("node").alias("a"), F.col("p").alias("pa")), up.select(F.col("node").alias("b"), F.col("p").alias("pb"))
        met = edges.join(a, "a", "left").join(b, "b", "left").select(F.coalesce("pa", "a").alias("x"), F.coalesce("pb", "b").alias("y"))
        edges = staged(met.where("x <> y").select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct(), "edges")
    if labels is None:
        return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return labels
