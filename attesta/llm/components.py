"""Connected components of an edge table, by repeated least labels and pointer jumps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from attesta.llm.common import ensure_checkpoint_dir


def components(edges: DataFrame, most_rounds: int = 60) -> DataFrame:
    """(node, root) for every node of the edges (a, b); the root is the least node of its component.

    Each round takes the least label among neighbours, summed up before the shuffle, then the
    label of that label. Labels are written to the checkpoint folder each round, so a lost
    executor costs one round at most. Only the number of changed labels reaches the driver.
    """
    ensure_checkpoint_dir(edges.sparkSession)
    both = edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).where("a <> b").distinct().checkpoint()
    labels = both.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.col("node")).alias("root")).checkpoint()
    for _ in range(most_rounds):
        near = both.join(labels, both.b == labels.node).groupBy(F.col("a").alias("n")).agg(F.min("root").alias("near"))
        least = labels.join(near, labels.node == near.n).select("node", F.col("root").alias("old"), F.least("root", "near").alias("root"))
        up = labels.select(F.col("node").alias("up_node"), F.col("root").alias("up"))
        jumped = least.join(up, least.root == up.up_node).select("node", "old", F.least("root", "up").alias("root")).checkpoint()
        labels = jumped.select("node", "root")
        if jumped.where("old <> root").isEmpty():
            return labels
    raise RuntimeError(f"components did not settle in {most_rounds} rounds")
