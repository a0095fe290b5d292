"""Connected components of an edge table, as joins; nothing but emptiness tests reaches the driver."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterloom.llm.common import stored


def components(edges: DataFrame) -> DataFrame:
    """node, label (the smallest node that it reaches) for every node of edges a, b.

    Every node hooks onto its smallest neighbour, chains are shortened by doubling until they end at
    roots, and edges between different roots go into the next round. Hubs are pre-aggregated.
    """
    edges = stored(edges.where("a <> b").select("a", "b").distinct(), "edges")
    labels = None
    while not edges.isEmpty():
        both = edges.union(edges.select("b", "a"))
        parent = stored(both.groupBy("a").agg(F.min("b").alias("b")).select("a", F.least("a", "b").alias("p")), "parents")
        while True:
            up = parent.select(F.col("a").alias("p"), F.col("p").alias("top"))
            parent = stored(parent.join(up, "p").select("a", F.col("top").alias("p"), (F.col("top") != F.col("p")).alias("moved")), "parents")
            moved, parent = parent.where("moved"), parent.drop("moved")
            if moved.isEmpty():
                break
        root = parent.select(F.col("a").alias("label"), F.col("p").alias("root"))
        if labels is None:
            labels = parent.select(F.col("a").alias("node"), F.col("p").alias("label"))
        else:
            labels = labels.join(root, "label", "left").select("node", F.coalesce("root", "label").alias("label"))
        labels = stored(labels, "labels")
        left = edges.join(root.select(F.col("label").alias("a"), F.col("root").alias("ra")), "a")
        both = left.join(root.select(F.col("label").alias("b"), F.col("root").alias("rb")), "b").where("ra <> rb")
        edges = stored(both.select(F.col("ra").alias("a"), F.col("rb").alias("b")).distinct(), "edges")
    if labels is None:
        labels = edges.select(F.col("a").alias("node"), F.col("b").alias("label"))
    return labels
