"""Connected components of a graph given as an edge table."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..session import settle


def components(edges: DataFrame) -> DataFrame:
    """(node, comp) for every node of ``edges`` (a, b: bigint); comp is the smallest node of its component.

    Each round a node takes the smallest label around it and then its label's label, so chains
    shrink by more than half. Every round is a written table; only a flag comes to the driver.
    """
    both = edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct()
    both = settle(both, "components-edges")
    labels = settle(both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("b")).select(
        "node", F.least("node", "b").alias("comp")), "components")
    while True:
        around = both.join(labels.select(F.col("node").alias("b"), "comp"), "b").groupBy(F.col("a").alias("node")).agg(F.min("comp").alias("near"))
        taken = labels.join(around, "node").select("node", F.col("comp").alias("old"), F.least("comp", "near").alias("comp"))
        jump = labels.select(F.col("node").alias("comp"), F.col("comp").alias("further"))
        after = settle(taken.join(jump, "comp").select("node", "old", F.least("comp", "further").alias("comp")), "components")
        labels = after.select("node", "comp")
        if after.where("old <> comp").isEmpty():
            return labels
