"""Connected components of a graph given by its links, in Spark."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from incident_engine.scratch import unsized


def components(links: DataFrame) -> DataFrame:
    """node, component for every node of the links (a, b): the smallest node reachable.

    Each round takes the smallest label among the neighbours and then the label of that label, so that
    distances halve; it ends when no label changes. Only labels and links move, and each round's labels
    are written, so no plan and no estimate of it grows and a lost executor costs one round. No links give no rows.
    """
    way = lambda a, b: F.struct(F.col(a).alias("node"), F.col(b).alias("near"))
    ways = F.array(way("a", "b"), way("b", "a"), way("a", "a"), way("b", "b"))  # its own neighbour, too: no round adds labels by a union
    both = links.select("a", "b").where("a <> b").select(F.explode(ways).alias("x")).select("x.*")
    both = unsized(both.distinct().checkpoint())
    labels = unsized(both.groupBy("node").agg(F.min("near").alias("component")).checkpoint())
    while True:
        seen = labels.select(F.col("node").alias("near"), F.col("component").alias("seen"))
        was = F.max(F.when(F.col("node") == F.col("near"), F.col("seen")))
        stepped = both.join(seen, "near").groupBy("node").agg(F.min("seen").alias("next"), was.alias("was"))
        jump = stepped.select(F.col("node").alias("next"), F.col("next").alias("far"))
        moved = stepped.join(jump, "next").select("node", "was", F.least("next", "far").alias("component")).checkpoint()
        labels = unsized(moved.select("node", "component"))
        if not moved.where("was <> component").head(1):  # isEmpty() would shuffle
            return labels
