"""Connected components of an edge table by minimum labels with pointer jumping."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hourloom.llm.common import staged


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of ``edges`` (columns a, b); root is the least node it reaches.

    Each round takes the least label among the neighbours and then the label of that label, so the
    rounds grow with the logarithm of a component's width. Every round is a join and a minimum with
    partial aggregation (a hub's edges are summed where they are and never gathered), written to
    the shared folder: a lost executor repeats a round's part only.
    """
    both = staged(edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
                  .where("a != b").distinct(), "edges")
    labels = staged(both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("m"))
                    .select("node", F.least("node", "m").alias("root")), "labels")
    while True:
        offered = (both.join(labels.select(F.col("node").alias("a"), "root"), "a")
                   .groupBy(F.col("b").alias("node")).agg(F.min("root").alias("offer")))
        lower = (labels.join(offered, "node")
                 .select("node", F.col("root").alias("was"), F.least("root", "offer").alias("root")))
        target = labels.select(F.col("node").alias("root"), F.col("root").alias("jump"))
        following = staged(lower.join(target, "root")
                           .select("node", "was", F.least("root", "jump").alias("root")), "labels")
        labels = following.select("node", "root")
        if following.where("root != was").isEmpty():
            return labels
