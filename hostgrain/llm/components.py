"""Connected components of an edge table, in a few joins each round."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hostgrain.llm.storage import written


def components(edges: DataFrame) -> DataFrame:
    """(node, component) for each end of the edges (a, b): component is the smallest node reachable.

    Each round takes the smallest label among the neighbours and then the label
    of that label, which halves the distances left; rounds end when none changes.
    Every round's labels are stored, so lost executors cost one round at most.
    """
    both = written(
        edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).where("a <> b").distinct(), "edges"
    )
    labels = written(both.groupBy(F.col("a").alias("node")).agg(F.least(F.first("a"), F.min("b")).alias("component")), "labels")
    while True:
        near = both.join(labels, F.col("b") == F.col("node")).groupBy("a").agg(F.min("component").alias("near"))
        step = labels.join(near, F.col("node") == F.col("a")).select(
            "node", F.col("component").alias("was"), F.least("component", "near").alias("next")
        )
        heads = labels.select(F.col("node").alias("head"), F.col("component").alias("of_head"))
        jumped = written(
            step.join(heads, F.col("next") == F.col("head")).select("node", F.least("next", "of_head").alias("component"), "was"), "labels"
        )
        labels = jumped.select("node", "component")
        if jumped.where("component <> was").isEmpty():
            return labels
