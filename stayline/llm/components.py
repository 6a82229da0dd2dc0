"""Connected components of an edge table by repeated contraction; nothing about single nodes reaches the driver."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stayline.session import cut_lineage


def components(edges: DataFrame) -> DataFrame:
    """Edges (a, b) of long ids to (node, root): root is the smallest id of the component.

    Each round every node points to its smallest neighbour, pointers are followed once more, and edges move to the nodes
    pointed at, so the graph shrinks by a constant factor and the number of rounds grows with the logarithm of the longest
    path. Minima are combined before the shuffle. Null ends and loops are no edges; no edges give no rows.
    """
    edges = cut_lineage(edges.where("a <> b").select("a", "b").distinct())
    labels = edges.select(F.col("a").alias("node")).union(edges.select("b")).distinct().withColumn("root", F.col("node"))
    while not edges.isEmpty():
        both = edges.select("a", "b").union(edges.select("b", "a"))
        nearest = cut_lineage(
            both.groupBy("a").agg(F.min("b").alias("b")).select(F.col("a").alias("at"), F.least("a", "b").alias("to"))
        )
        onward = nearest.select(F.col("at").alias("to"), F.col("to").alias("past"))
        step = cut_lineage(nearest.join(onward, "to").select("at", "past"))
        labels = cut_lineage(
            labels.join(step.withColumnRenamed("at", "root"), "root", "left").select(
                "node", F.coalesce("past", "root").alias("root")
            )
        )
        left, right = step.toDF("a", "a2"), step.toDF("b", "b2")
        edges = cut_lineage(
            edges.join(left, "a")
            .join(right, "b")
            .where("a2 <> b2")
            .select(F.least("a2", "b2").alias("a"), F.greatest("a2", "b2").alias("b"))
            .distinct()
        )
    return labels
