"""Connected components of an edge table, as Spark joins and aggregations."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from coverloom.llm.common import settle


def components(edges: DataFrame) -> DataFrame:
    """node, root for every node of ``edges`` (a, b: long): the smallest node in reach.

    Every round takes the smallest label among a node and its neighbours and then the label
    of that label, so the distance a label travels doubles. Rounds end when no label changes.
    Edges may repeat and may be given in one direction; nulls are not allowed.
    """
    both = edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    both = settle(both.filter("a <> b").distinct(), "component-edges")
    labels = settle(both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("root")).withColumnRenamed("a", "node"), "component-labels")
    while True:
        near = (
            both.join(labels.select(F.col("node").alias("b"), F.col("root").alias("their")), "b")
            .groupBy(F.col("a").alias("node")).agg(F.min("their").alias("their"))
        )
        lower = labels.join(near, "node").select("node", F.col("root").alias("old"), F.least("root", "their").alias("root"))
        jump = labels.select(F.col("node").alias("root"), F.col("root").alias("next"))
        moved = settle(
            lower.join(jump, "root", "left").select("node", F.least("root", F.coalesce("next", "root")).alias("root"), "old"),
            "component-labels",
        )
        labels = moved.select("node", "root")
        if moved.filter("root <> old").isEmpty():
            return labels
