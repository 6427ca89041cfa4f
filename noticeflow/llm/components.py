"""Connected components of a graph given as a table of edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from noticeflow.llm.common import drop_staged, stage


def components(edges: DataFrame) -> DataFrame:
    """(node, label) for every node of ``edges`` (a, b); the label is the smallest node of the
    component. Smallest labels are passed along the edges and then looked up once more, so
    paths shorten by half in each round; a round is a written table, so lineage stays short
    and nothing is collected but the number of changes.
    """
    both = edges.filter("a <> b").select("a", "b")
    both = stage(both.unionByName(both.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "edges")
    labels = stage(both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("low")).select(
        "node", F.least("node", "low").alias("label")), "labels")
    while True:
        near = both.join(labels, both.b == labels.node).groupBy(F.col("a").alias("node")).agg(
            F.min("label").alias("low"))
        lower = labels.join(near, "node").select("node", F.col("label").alias("old"), F.least("label", "low").alias("label"))
        lower = stage(lower, "labels")
        up = lower.select(F.col("node").alias("label"), F.col("label").alias("above"))
        after = stage(lower.join(up, "label").select(
            "node", "old", F.col("above").alias("label")), "labels")
        changed = after.filter("label <> old").limit(1).count()
        drop_staged(lower)
        drop_staged(labels)
        labels = after.select("node", "label")
        if not changed:
            drop_staged(both)
            return labels
