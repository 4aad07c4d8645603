"""Connected components of an edge table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .storage import saved


def components(edges: DataFrame) -> DataFrame:
    """``node, component`` (its smallest node) for edges ``a, b`` of long ids.

    Every round takes the smallest label among neighbours, combined before the shuffle so
    that a hub is one row per task, and then the label of the label, which halves long
    chains. Rounds are written to the shared folder; the driver sees one count per round.
    No edges: no rows. Loops and repeated edges change nothing; edges with null are ignored.
    """
    both = edges.where("a is not null and b is not null and a <> b").select("a", "b")
    both = saved(both.union(both.select("b", "a")).distinct(), "edges")
    labels = saved(both.groupBy(F.col("a").alias("node")).agg(
        F.least("a", F.min("b")).alias("component")), "labels")
    while True:
        near = (
            both.join(labels, both.b == labels.node)
            .groupBy("a").agg(F.min("component").alias("low"))
        )
        # saved, as it is read twice, and so that the join on a hub is one of two plain
        # shuffles, which Spark can split
        lower = saved(labels.join(near, labels.node == near.a).select(
            "node", F.least("component", "low").alias("next"), F.col("component").alias("was")), "labels")
        of = lower.select(F.col("node").alias("at"), F.col("next").alias("jump"))
        after = saved(
            lower.join(of, lower.next == of.at, "left")
            .select("node", F.least("next", F.coalesce("jump", "next")).alias("component"),
                    (F.least("next", F.coalesce("jump", "next")) < F.col("was")).alias("moved")),
            "labels")
        labels = after.select("node", "component")
        if not after.where("moved").limit(1).count():
            return labels
