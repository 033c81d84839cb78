"""Connected components of a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderlake.llm.scratch import stored


def connected(links: DataFrame) -> DataFrame:
    """links: x, y. By node that has a link: node, component, its smallest node.

    In each round a node takes the smallest label among its neighbours, then the label of its label, which halves paths. Rounds
    are written as tables, so that no lineage grows. Minima combine before the shuffle, however many neighbours a node has.
    """
    edges = stored(links.select("x", "y").union(links.select(F.col("y"), F.col("x"))).where("x != y").distinct(), "edges")
    labels = stored(edges.groupBy(F.col("x").alias("node")).agg(F.min("y").alias("near")).select("node", F.least("node", "near").alias("component")), "labels")
    while True:
        near = edges.join(labels, F.col("y") == F.col("node")).groupBy("x").agg(F.min("component").alias("near"))
        closer = labels.join(near, F.col("node") == F.col("x")).select("node", F.col("component").alias("old"), F.least("component", "near").alias("label"))
        above = labels.select(F.col("node").alias("above"), F.col("component").alias("top"))
        jumped = stored(closer.join(above, F.col("label") == F.col("above")).select("node", F.least("label", "top").alias("component"), (F.least("label", "top") != F.col("old")).alias("moved")), "labels")
        labels = jumped.select("node", "component")
        if jumped.where("moved").isEmpty():
            return labels
