"""Connected components of a distributed edge list."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stage


def components(edges: DataFrame) -> DataFrame:
    """(a, b) edges -> (node, label), label the smallest node reachable.

    Every round takes the smallest label among the neighbours and then the
    label of that label, so long chains halve. Each round's labels are
    written to the shared folder. The links and labels stay distributed;
    only the number of changed labels comes back.
    """
    links = edges.select("a", "b").union(edges.select("b", "a")).filter("a <> b").distinct()
    links = stage(links, "links")
    labels = stage(links.groupBy(F.col("a").alias("node")).agg(F.least(F.col("node"), F.min("b")).alias("label")), "labels")
    while True:
        near = (
            links.join(labels.select(F.col("node").alias("b"), "label"), "b")
            .groupBy(F.col("a").alias("node")).agg(F.min("label").alias("near"))
        )
        step = labels.join(near, "node", "left").select("node", F.col("label").alias("old"), F.least("label", "near").alias("label"))
        of_label = labels.select(F.col("node").alias("label"), F.col("label").alias("further"))
        step = step.join(of_label, "label", "left").select("node", "old", F.least("label", "further").alias("label"))
        step = stage(step, "labels")
        labels = step.select("node", "label")
        if step.filter("old <> label").isEmpty():
            return labels
