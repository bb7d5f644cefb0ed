"""Connected components of a link table by minimum labels and pointer jumping."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakelens.llm.common import settled


def components(links: DataFrame) -> DataFrame:
    """(node, label) for the nodes of ``links`` (a, b): the smallest node reachable.

    Labels stay in tables; the driver sees one count per round."""
    edges = settled(links.select(F.col("a").alias("u"), F.col("b").alias("v"))
                    .unionAll(links.select(F.col("b").alias("u"), F.col("a").alias("v"))).distinct(), "edges")
    labels = settled(edges.groupBy(F.col("u").alias("node")).agg(F.least("u", F.min("v")).alias("label")), "labels")
    while True:
        near = edges.join(labels.select(F.col("node").alias("v"), "label"), "v").groupBy(F.col("u").alias("node")).agg(F.min("label").alias("near"))
        lower = labels.join(near, "node").select("node", F.col("label").alias("old"), F.least("label", "near").alias("label"))
        jump = labels.select(F.col("node").alias("label"), F.col("label").alias("beyond"))
        moved = settled(lower.join(jump, "label").select("node", "old", F.least("label", "beyond").alias("label")), "labels")
        labels = moved.select("node", "label")
        if moved.filter("label <> old").isEmpty():
            return labels
