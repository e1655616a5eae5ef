"""Connected components of links inside groups, by joins alone."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .lineage import cut


def connected(links: DataFrame, group: list[str], rounds: int = 60) -> DataFrame:
    """links (group, a, b) to group, node, root: the least node reachable. Nodes without a link are absent.

    Each round gives every node the least label next to it, takes its label's other
    nodes along, and then follows labels one step further, so the distance that a
    label covers doubles. A round is two aggregations and four joins on (group,
    node or label), and is cut from those before.
    """
    edges = links.where("a != b").select(*group, "a", "b")
    edges = cut(edges.unionByName(edges.select(*group, F.col("b").alias("a"), F.col("a").alias("b"))).distinct())
    labels = cut(edges.groupBy(*group, F.col("a").alias("node")).agg(F.least(F.col("node"), F.min("b")).alias("root")))
    for _ in range(rounds):
        around = edges.join(labels.withColumnRenamed("node", "b"), [*group, "b"]).groupBy(*group, F.col("a").alias("node")).agg(F.min("root").alias("_near"))
        least = labels.join(around, [*group, "node"]).select(*group, "node", F.col("root").alias("_before"), F.least("root", "_near").alias("_least"))
        # hooking: a root that has learnt of a lesser one takes all its nodes along
        moved = least.groupBy(*group, F.col("_before").alias("_root")).agg(F.min("_least").alias("_new"))
        new = least.withColumn("_root", F.col("_before")).join(moved, [*group, "_root"]).select(*group, "node", "_before", F.least("_least", "_new").alias("root"))
        new = cut(new)
        after = new.select(*group, F.col("node").alias("root"), F.col("root").alias("_after"))
        new = cut(new.join(after, [*group, "root"]).select(*group, "node", "_before", F.col("_after").alias("root")))
        if new.where("root != _before").isEmpty():
            return new.select(*group, "node", "root")
        labels = new.select(*group, "node", "root")
    raise RuntimeError(f"components did not settle in {rounds} rounds")
