"""Connected components of a graph given by its edges."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from sensorloom.llm.common import written


def components(edges: DataFrame) -> DataFrame:
    """node, component (the least node reachable) of every node that has an edge.

    Each round replaces a node's label by the least one around it and then by that label's own label,
    so labels travel ever farther per round. Every round is a written table: lineage stays short and a
    lost executor costs one round at most. Edges are a, b (long); loops and repeats do no harm.
    """
    both = edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    both = written(both.where("a != b").distinct(), "edges")
    labels = written(both.groupBy(F.col("a").alias("node")).agg(F.least("a", F.min("b")).alias("component")), "labels")
    while True:
        near = both.join(labels.select(F.col("node").alias("b"), "component"), "b")
        near = near.groupBy(F.col("a").alias("node")).agg(F.min("component").alias("near"))
        moved = labels.join(near, "node").select(
            "node", F.col("component").alias("before"), F.least("component", "near").alias("component")
        )
        jump = labels.select(F.col("node").alias("component"), F.col("component").alias("next"))
        moved = moved.join(jump, "component", "left").select(
            "node", "before", F.least("component", F.coalesce("next", "component")).alias("component")
        )
        moved = written(moved, "labels")
        labels = moved.select("node", "component")
        if moved.where("before != component").isEmpty():
            return labels
