"""Connected components of a graph given as edges, by minimum labels with pointer jumping."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pulseboard.llm.common import stored


def connected_components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, label): the least node of its component, for each node that has an edge.

    Each round takes the least label among a node's neighbours and then the label of that label; it is
    written to the shared folder, and the last round is the one that changes nothing.  Only counts reach the driver.
    """
    e = edges.select(F.col(a).alias("x"), F.col(b).alias("y")).where("x != y")
    e = stored(e.unionByName(e.select(F.col("y").alias("x"), F.col("x").alias("y"))).distinct(), "edges")
    labels = stored(e.groupBy(F.col("x").alias("node")).agg(F.min("y").alias("m")).select("node", F.least("node", "m").alias("label")), "labels")
    while True:
        near = e.join(labels, e["y"] == labels["node"]).groupBy("x").agg(F.min("label").alias("m"))
        new = labels.join(near, labels["node"] == near["x"]).select("node", F.col("label").alias("old"), F.least("label", "m").alias("label"))
        up = labels.select(F.col("node").alias("at"), F.col("label").alias("above"))
        labels = stored(new.join(up, F.col("label") == F.col("at")).select("node", "old", F.least("label", "above").alias("label")), "labels")
        if not labels.where("label != old").limit(1).count():
            return labels.select("node", "label")
        labels = labels.select("node", "label")
