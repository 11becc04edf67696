"""Connected components by repeated joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rankframe.llm.common import stored


def components(edges: DataFrame) -> DataFrame:
    """``(node, component)`` for the nodes of ``edges(a, b)``; a component is named by its
    smallest node.

    Each round takes the least label among a node and its neighbours, then the label's own
    label, so chains shorten by half and more; it ends when nothing changes. Nothing is
    gathered; the state lies in the shared folder.
    """
    both = stored(edges.select("a", "b").union(edges.select("b", "a")).distinct(), "edges")
    labels = stored(both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("label")).withColumnRenamed("a", "node"), "labels")
    while True:
        heard = both.join(labels, both.b == labels.node).groupBy("a").agg(F.min("label").alias("heard")).withColumnRenamed("a", "node")
        least = stored(labels.join(heard, "node").select("node", F.col("label").alias("was"), F.least("label", "heard").alias("label")), "labels")
        owner = least.select(F.col("node").alias("label"), F.col("label").alias("next"))
        jumped = stored(least.join(owner, "label", "left").select("node", "was", F.coalesce("next", "label").alias("label")), "labels")
        if jumped.where("label <> was").isEmpty():
            return jumped.select("node", F.col("label").alias("component"))
        labels = jumped.select("node", "label")
