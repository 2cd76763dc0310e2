"""Connected components by joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from topiclog.llm.base import stored


def _state(labels: DataFrame) -> tuple:
    return tuple(labels.agg(F.count(F.lit(1)), F.sum(F.col("label").cast("decimal(38,0)"))).first())


def components(edges: DataFrame) -> DataFrame:
    """(node, label) for every node of ``edges`` (a long, b long): label is the least node that it reaches.

    Each round takes the least label among the neighbours, then the label of that label, so that the distance
    covered grows with every round; labels only fall, and the rounds end when their sum stays. Both
    sides of every join are stored tables, so adaptive execution splits the partitions of a hot node. Edges with
    a null end are no edges; no edges give no rows.
    """
    edges = edges.where(F.col("a").isNotNull() & F.col("b").isNotNull())
    both = stored(edges.select("a", "b").union(edges.select(F.col("b"), F.col("a"))).distinct(), "edges")
    labels = stored(both.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.col("a")).alias("label")), "labels")
    state = _state(labels)
    while True:
        reached = (
            both.join(labels.withColumnRenamed("node", "b"), "b")
            .groupBy(F.col("a").alias("node")).agg(F.min("label").alias("near"))
        )
        hooked = stored(
            labels.join(reached, "node").select("node", F.least("label", "near").alias("label")), "hooked")
        up = hooked.select(F.col("node").alias("label"), F.col("label").alias("up"))
        labels = stored(hooked.join(up, "label").select("node", F.least("label", "up").alias("label")), "labels")
        before, state = state, _state(labels)
        if state == before:
            return labels
