"""Connected components of a distributed edge list by minimum labels and pointer jumping."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skyledger.llm.store import discard, save


def connected_components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``node, component``: the smallest node reachable, for every node of ``edges``.

    Each round takes the smallest label among a node and its neighbours, then
    follows label to label once, so chains shorten geometrically. Labels are
    written in the shared folder each round; nothing is collected but a count.
    """
    both = save(
        edges.select(F.col(a).alias("u"), F.col(b).alias("v"))
        .unionByName(edges.select(F.col(b).alias("u"), F.col(a).alias("v"))).distinct(), "edges")
    labels = save(both.groupBy("u").agg(F.min("v").alias("m"))
                  .select(F.col("u").alias("node"), F.least("u", "m").alias("component")), "labels")
    while True:
        near = (both.join(labels, both["v"] == labels["node"]).groupBy("u").agg(F.min("component").alias("m")))
        step = (labels.join(near, labels["node"] == near["u"])
                .select("node", F.least("component", "m").alias("to"), F.col("component").alias("old")))
        hop = labels.select(F.col("node").alias("to"), F.col("component").alias("up"))
        after = save(step.join(hop, "to").select("node", F.least("to", "up").alias("component"), "old"), "labels")
        moved = after.filter("component <> old").limit(1).count()
        discard(labels)
        labels = after
        if not moved:
            discard(both)
            return labels.select("node", "component")
