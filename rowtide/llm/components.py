"""Connected components of links that stay distributed."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rowtide.llm.tables import stored


def components(links: DataFrame) -> DataFrame:
    """``node`` and ``label`` (smallest node reachable) of every node of ``links`` (a, b).

    Each round takes the smallest label among a node's neighbours, then the label of its label, so
    chains halve; it ends when nothing changes. Every round is written to the shared folder.
    """
    both = links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).where("a <> b")
    edges = stored(both.distinct(), "edges")
    labels = stored(edges.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("label")).select("node", F.least("node", "label").alias("label")), "labels")
    while True:
        near = edges.join(labels.withColumnRenamed("node", "b"), "b").groupBy(F.col("a").alias("node")).agg(F.min("label").alias("_near"))
        lower = labels.join(near, "node").select("node", F.col("label").alias("_old"), F.least("label", "_near").alias("label"))
        lower = stored(lower, "lower")
        far = lower.select(F.col("node").alias("label"), F.col("label").alias("_far"))
        new = lower.join(far, "label").select("node", F.least("label", "_far").alias("label"), (F.least("label", "_far") < F.col("_old")).alias("_changed"))
        new = stored(new, "labels")
        if new.where("_changed").isEmpty():
            return new.select("node", "label")
        labels = new.select("node", "label")
