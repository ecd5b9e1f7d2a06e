"""Connected components of a table of links, as a loop of joins and aggregates."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tagweave.llm.common import staged


def components(links: DataFrame) -> DataFrame:
    """(node, component) for every node of links (a, b); the component is its smallest node.

    Each round takes the smallest label among neighbours, then the label of that
    label, so long chains shorten by halves. A round's labels are written to the
    shared folder. Links may repeat, point to themselves and have any direction;
    nodes may be of any type that can be ordered. No links give no rows.
    """
    ends = links.select("a", "b")
    edges = staged(ends.unionByName(ends.select(F.col("b").alias("a"), F.col("a").alias("b")))
                   .distinct(), "edges")
    labels = staged(edges.groupBy(F.col("a").alias("node"))
                    .agg(F.least(F.col("a"), F.min("b")).alias("label")), "labels")
    while True:
        near = (edges.join(labels, edges["b"] == labels["node"])
                .groupBy(F.col("a").alias("node")).agg(F.min("label").alias("near")))
        lower = labels.join(near, "node").select(
            "node", F.least("label", "near").alias("label"), F.col("label").alias("before"))
        root = labels.select(F.col("node").alias("label"), F.col("label").alias("root"))
        moved = staged(lower.join(root, "label").select(
            "node", F.least("label", "root").alias("label"), "before"), "labels")
        labels = moved.select("node", "label")
        if moved.filter(F.col("label") != F.col("before")).isEmpty():
            return labels.withColumnRenamed("label", "component")
