"""Connected components of links between nodes, as joins that end after few rounds.

Every node takes the smallest label among its neighbours, then the label of its label.
Each round is written to the shared folder, so lineage stays short and a lost executor
costs at most one round.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillwise.config import scratch_dir


def stored(frame: DataFrame, label: str) -> DataFrame:
    """``frame`` written once below the shared folder and read from there."""
    folder = scratch_dir(frame.sparkSession, label)
    frame.write.parquet(folder)
    return frame.sparkSession.read.schema(frame.schema).parquet(folder)


def components(links: DataFrame) -> DataFrame:
    """``node, component`` of every node in ``links`` (``a, b``); a component is its smallest node."""
    both = links.select("a", "b").union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    edges = stored(both.distinct(), "edges")
    labels = stored(
        edges.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("least")).select(
            "node", F.least("node", "least").alias("component")
        ),
        "labels",
    )
    while True:
        near = edges.join(labels.select(F.col("node").alias("b"), "component"), "b")
        least = near.groupBy(F.col("a").alias("node")).agg(F.min("component").alias("least"))
        lowered = labels.join(least, "node").select(
            "node", F.col("component").alias("old"), F.least("component", "least").alias("component")
        )
        jump = labels.select(F.col("node").alias("component"), F.col("component").alias("far"))
        moved = lowered.join(jump, "component", "left").select(
            "node", "old", F.least("component", F.coalesce("far", "component")).alias("component")
        )
        after = stored(moved, "labels")
        labels = after.select("node", "component")
        if not after.where("old <> component").limit(1).count():
            return labels


def merged(labels: DataFrame, links: DataFrame) -> DataFrame:
    """``labels`` after more links, given as pairs of components ``component, rep_component``.

    Only the components are joined, so nodes of settled components take no part in the
    rounds.  A node without a label is a component of its own.
    """
    joined = components(links.select(F.col("component").alias("a"), F.col("rep_component").alias("b")))
    fresh = joined.select("node", F.col("node").alias("component")).join(labels, "node", "left_anti")
    into = joined.select(F.col("node").alias("component"), F.col("component").alias("into"))
    moved = labels.union(fresh).join(into, "component", "left")
    return stored(moved.select("node", F.coalesce("into", "component").alias("component")), "labels")
