"""Connected components of a table of links by label propagation with pointer jumping."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetmeter.session import spill_to_table


def components(links: DataFrame) -> DataFrame:
    """node and component (the smallest node reachable) of every node that a link names.

    links: columns a and b. Every round gives a node the smallest label among itself and its
    neighbours, then that label's own label, so chains shorten by half or more; a round's labels
    are a table in the shared folder. A node with many neighbours is summed up before the shuffle.
    """
    both = links.select("a", "b").union(links.select(F.col("b"), F.col("a"))).where("a <> b").distinct()
    edges = spill_to_table(both, "edges")
    labels = spill_to_table(edges.groupBy("a").agg(F.least("a", F.min("b")).alias("label")).withColumnRenamed("a", "node"), "labels")
    while True:
        nearest = edges.join(labels.select(F.col("node").alias("b"), "label"), "b").groupBy(F.col("a").alias("node")).agg(F.min("label").alias("near"))
        better = labels.join(nearest, "node").select("node", F.col("label").alias("old"), F.least("label", "near").alias("label"))
        jump = labels.select(F.col("node").alias("label"), F.col("label").alias("beyond"))
        after = better.join(jump, "label", "left").select("node", "old", F.least("label", "beyond").alias("label"))
        after = spill_to_table(after, "labels")
        labels = after.select("node", "label")
        if after.where("label <> old").isEmpty():
            return labels.withColumnRenamed("label", "component")
