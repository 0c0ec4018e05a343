"""Connected components of a graph whose edges are spread over the cluster."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from filmgrid.session import written


def components(edges: DataFrame) -> DataFrame:
    """``(node, component)``: the smallest node reachable, for every node that occurs in an edge ``(a, b)``.

    Every round takes each node's smallest neighbour so far and then follows the labels one step further, so that a
    chain shrinks by a power of two a round and a star is done at once. Labels are folded per task before the shuffle;
    a node with many edges is never gathered. Each round's labels are written to the shared folder. Edges may repeat
    and may be loops; the order of nodes is that of their type.
    """
    both = written(
        edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "component-edges"
    )
    labels = written(both.groupBy("a").agg(F.least("a", F.min("b")).alias("label")).withColumnRenamed("a", "node"), "component-labels")
    while True:
        of = labels.select(F.col("node").alias("b"), F.col("label").alias("near"))
        nearest = both.join(of, "b").groupBy(F.col("a").alias("node")).agg(F.min("near").alias("near"))
        lower = labels.join(nearest, "node").select("node", F.col("label").alias("old"), F.least("label", "near").alias("via"))
        # a label is a node itself, so its own label is one more step towards the smallest
        onward = labels.select(F.col("node").alias("via"), F.col("label").alias("next"))
        moved = written(
            lower.join(onward, "via").select("node", "old", F.least("via", "next").alias("label")), "component-labels"
        )
        labels = moved.select("node", "label")
        if moved.where("old <> label").isEmpty():
            return labels.withColumnRenamed("label", "component")
