"""Connected components of a graph of any size and shape, by least labels and pointer jumps over written tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from sorrel.llm.rows import written


def components(links: DataFrame, a: str, b: str) -> DataFrame:
    """(node, component) for every node in `links`, `component` being the least node it can reach.

    Every round takes the least label among neighbours, then the label of that label. Rounds grow with the logarithm of
    the longest shortest path as labels are jumped over; each is written, so a lost executor costs one round.
    """
    both = links.select(F.col(a).alias("x"), F.col(b).alias("y"))
    edges = written(both.unionByName(both.select(F.col("y").alias("x"), F.col("x").alias("y"))).where("x <> y"), "edges")
    labels = written(edges.groupBy(F.col("x").alias("node")).agg(F.least(F.col("node"), F.min("y")).alias("label")), "labels")
    while True:
        near = edges.join(labels, F.col("y") == F.col("node")).groupBy("x").agg(F.min("label").alias("seen"))
        hop = labels.join(near, F.col("node") == F.col("x")).select("node", F.col("label").alias("was"), F.least("label", "seen").alias("label"))
        to = labels.select(F.col("node").alias("t"), F.col("label").alias("far"))
        jumped = hop.join(to, F.col("label") == F.col("t")).select("node", "was", F.least("label", "far").alias("label"))
        labels = written(jumped, "labels")
        if labels.where("label <> was").limit(1).count() == 0:
            return labels.select("node", F.col("label").alias("component"))
        labels = labels.drop("was")
