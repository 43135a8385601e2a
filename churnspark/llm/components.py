"""Connected components of a distributed edge table by least labels with pointer jumping."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from churnspark.llm.tables import written


def connected(edges: DataFrame) -> DataFrame:
    """(node, root): the smallest node that can be reached, for every node of ``edges`` (a, b).

    Each round takes the least label over the neighbours, summed up map-side, and then the label's own label, so a chain
    shortens by half. Rounds go on until nothing changes; each is written, so its lineage is short.
    """
    both = edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    both = written(both.filter(F.col("a") != F.col("b")).distinct(), "edges")
    least = both.groupBy("a").agg(F.min("b").alias("b"))
    labels = written(least.select(F.col("a").alias("node"), F.least("a", "b").alias("root")), "labels")
    while True:
        near = (both.join(labels, both["b"] == labels["node"]).groupBy("a").agg(F.min("root").alias("near")))
        moved = labels.join(near, labels["node"] == near["a"]).select(
            "node", F.col("root").alias("old"), F.least("root", "near").alias("root"))
        own = labels.select(F.col("node").alias("at"), F.col("root").alias("next"))
        # The label of the label: roots are nodes themselves.
        jumped = moved.join(own, moved["root"] == own["at"], "left").select(
            "node", "old", F.least("root", F.coalesce("next", "root")).alias("root"))
        new = written(jumped, "labels")
        labels = new.select("node", "root")
        if new.filter(F.col("old") != F.col("root")).isEmpty():
            return labels
