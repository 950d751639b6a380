"""Connected components by joins, with nothing on the driver but a count per round."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from opinara.llm.common import stored


def components(edges: DataFrame) -> DataFrame:
    """``node, label`` for every node of the undirected ``edges`` (a, b): the smallest node it can reach.

    Each round hooks: every edge tells both its ends, and the labels of its ends,
    the smaller label it knows; then every node takes its label's label. A
    component of n nodes settles in about log n rounds. Rounds are written tables,
    so a lost executor costs a read.
    """
    both = edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    both = stored(both.filter("a <> b").distinct(), "edges")
    # The first round needs no join: the smallest of a node and its neighbours.
    labels = stored(both.groupBy(F.col("a").alias("node")).agg(F.least("node", F.min("b")).alias("label")), "labels")
    while True:
        left = labels.select(F.col("node").alias("a"), F.col("label").alias("label_a"))
        right = labels.select(F.col("node").alias("b"), F.col("label").alias("label_b"))
        seen = both.join(left, "a").join(right, "b")
        told = seen.filter("label_b < label_a").select(
            F.explode(F.array("a", "label_a")).alias("node"), F.col("label_b").alias("label")
        )
        hooked = labels.union(told).groupBy("node").agg(F.min("label").alias("label"))
        jump = hooked.select(F.col("node").alias("label"), F.col("label").alias("next"))
        after = hooked.join(jump, "label").select("node", F.col("next").alias("label"))
        before = labels.withColumnRenamed("label", "old")
        settled = stored(after.join(before, "node"), "labels")
        labels = settled.select("node", "label")
        if settled.filter("label <> old").isEmpty():
            return labels
