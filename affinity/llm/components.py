"""Connected components of an edge table, by minimum labels and pointer jumping."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from affinity.llm.stage import written


def components(edges: DataFrame, rounds: int | None = None) -> DataFrame:
    """``node, label`` for every node of ``edges`` (``a, b``): equal labels, connected nodes.

    The label is the component's smallest node. Each round gives a node the smallest label among
    its neighbours and itself, then the label of that label; a component is done after about
    the logarithm of its longest path. Each round is written; counts alone reach the driver.

    With ``rounds`` it stops early: equal labels still mean connected nodes, but some connected
    nodes may have different labels.
    """
    own = edges.select("a", F.col("a").alias("b")).union(edges.select("b", F.col("b").alias("a")))
    both = written(edges.select("a", "b").union(edges.select("b", "a")).union(own).distinct())
    labels = written(both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("label")))
    while rounds is None or rounds > 0:
        near = (both.join(labels.select(F.col("node").alias("b"), "label"), "b")
                .groupBy(F.col("a").alias("node")).agg(
                    F.min("label").alias("near"), F.max(F.when(F.col("a") == F.col("b"), F.col("label"))).alias("old")))
        jump = labels.select(F.col("node").alias("near"), F.col("label").alias("next"))
        new = written(near.join(jump, "near").select("node", "old", F.least("near", "next").alias("label")))
        labels = new.select("node", "label")
        rounds = None if rounds is None else rounds - 1
        if rounds is None and new.where("label <> old").isEmpty():
            return labels
    return labels
