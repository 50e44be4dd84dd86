"""Connected components by smallest labels, as Spark joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stored


def components(edges: DataFrame) -> DataFrame:
    """id, label: the smallest id reachable from each id that has an edge. edges: a, b (long).

    Each round takes the smallest label among the neighbours and then the label of that label, so
    paths halve; rounds end when no label changes.
    """
    both = stored(edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct())
    labels = stored(both.groupBy(F.col("a").alias("id")).agg(F.least(F.col("id"), F.min("b")).alias("label")))
    while True:
        near = both.join(labels, both["b"] == labels["id"]).groupBy("a").agg(F.min("label").alias("near"))
        step = labels.join(near, labels["id"] == near["a"], "left").select("id", F.least("label", "near").alias("label"), F.col("label").alias("old"))
        jump = labels.select(F.col("id").alias("_id"), F.col("label").alias("_label"))
        new = stored(step.join(jump, step["label"] == jump["_id"], "left").select("id", F.least("label", "_label").alias("label"), "old"))
        if new.where(F.col("label") != F.col("old")).isEmpty():
            return new.select("id", "label")
        labels = new.select("id", "label")
