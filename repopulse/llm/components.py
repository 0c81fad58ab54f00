"""Connected components by smallest label, with pointer jumping."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from repopulse.llm.store import stored


def components(links: DataFrame) -> DataFrame:
    """(node, component) of every node in `links` (a, b): the smallest node it is connected with.

    Every round takes the smallest label among the neighbours and then the label of that label, so
    the rounds grow with the logarithm of the longest path. Each round is stored in the shared
    folder. A node with very many links is a few rows in each aggregation, and adaptive execution
    splits it in the joins. Null ends and loops are ignored.
    """
    both = links.select(F.col("a"), F.col("b")).where("a is not null and b is not null and a <> b")
    edges = stored(both.unionByName(both.selectExpr("b as a", "a as b")).distinct(), "edges")
    labels = stored(edges.groupBy("a").agg(F.min("b").alias("c")).selectExpr("a as node", "least(a, c) as c"), "labels")
    while True:
        near = edges.join(labels.selectExpr("node as b", "c"), "b").groupBy("a").agg(F.min("c").alias("near"))
        lowered = labels.join(near.withColumnRenamed("a", "node"), "node").selectExpr(
            "node", "c as old", "least(c, near) as c"
        )
        lowered = stored(lowered, "lowered")
        jump = lowered.selectExpr("node as at", "c as further")
        labels_next = lowered.join(jump, F.col("c") == F.col("at"), "left").selectExpr(
            "node", "old", "coalesce(least(c, further), c) as c"
        )
        labels_next = stored(labels_next, "labels")
        if labels_next.where("c <> old").isEmpty():
            return labels_next.selectExpr("node", "c as component")
        labels = labels_next.select("node", "c")
