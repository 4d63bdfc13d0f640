"""Connected components of links, in rounds of joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wattloom.llm.common import saved


def components(links: DataFrame) -> DataFrame:
    """Rows (node, component) of all nodes of the links (a, b); the component is its least node.

    Each round a node takes the least label among its own, its neighbours' and that of the node its
    label names, so that paths shorten by half and more. Every round is written, and the loop ends
    when a round changes nothing. No node's neighbours meet in one task: they are pre-aggregated.
    """
    edges = saved(links.select("a", "b").union(links.select("b", "a")).distinct(), "edges")
    labels = saved(
        edges.groupBy("a").agg(F.min("b").alias("least"))
        .select(F.col("a").alias("node"), F.least("a", "least").alias("component")),
        "labels",
    )
    while True:
        near = edges.join(labels, F.col("b") == F.col("node")).groupBy("a").agg(
            F.min("component").alias("near")
        )
        far = labels.select(F.col("node").alias("_at"), F.col("component").alias("far"))
        step = (
            labels.join(near, F.col("node") == F.col("a"))
            .join(far, F.col("component") == F.col("_at"), "left")
            .select("node", F.col("component").alias("old"), F.least("component", "near", "far").alias("component"))
        )
        step = saved(step, "labels")
        labels = step.select("node", "component")
        if step.where(F.col("component") != F.col("old")).isEmpty():
            return labels
