"""Connected components of a graph given by its links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postpulse.sources import materialise


def components(links: DataFrame) -> DataFrame:
    """(node, label): the smallest node reachable, for each node of links (a, b).

    Each round a node takes the smallest of its own label, the labels around it and
    its label's label, which shortens long chains by half. Rounds are stored, so a
    lost executor costs one of them; only whether anything changed reaches the driver.
    Nodes without links have no row, null ends are left out.
    """
    known = links.where("a is not null and b is not null and a <> b").select("a", "b")
    both = known.unionByName(known.select(F.col("b").alias("a"), F.col("a").alias("b")))
    both = materialise(both.distinct(), "links")
    nearest = both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("label"))
    labels = materialise(nearest.select("node", F.least("node", "label").alias("label")), "labels")
    while True:
        around = (
            both.join(labels.select(F.col("node").alias("b"), "label"), "b")
            .groupBy(F.col("a").alias("node"))
            .agg(F.min("label").alias("_near"))
        )
        further = labels.select(F.col("node").alias("_to"), F.col("label").alias("_far"))
        nearer = (
            labels.join(around, "node")
            .join(further, F.col("label") == F.col("_to"))
            .select("node", F.col("label").alias("_old"), F.least("label", "_near", "_far").alias("label"))
        )
        nearer = materialise(nearer, "labels")
        labels = nearer.select("node", "label")
        if nearer.where("label <> _old").isEmpty():
            return labels
