"""Connected components of an edge table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folioforge.runtime import materialize


def connected_components(edges: DataFrame, rounds: int = 60) -> DataFrame:
    """``(node, component)`` for the nodes of ``edges(a, b)``; a component is named by its least node.

    Each round takes the least label of a node and its neighbours and then the
    label of that label, so paths halve and a few rounds do for any shape; each
    round is written out, and only nodes and labels are shuffled. Null ends are
    dropped, loops and repeated edges do no harm, no edges give no rows.
    """
    e = edges.where("a is not null and b is not null").select("a", "b")
    both = materialize(e.union(e.select("b", "a")).distinct(), "edges")
    labels = materialize(both.groupBy("a").agg(F.least("a", F.min("b")).alias("l")).select(F.col("a").alias("node"), "l"), "labels")
    for _ in range(rounds):
        near = both.join(labels.select(F.col("node").alias("b"), F.col("l").alias("lb")), "b").groupBy(F.col("a").alias("node")).agg(F.min("lb").alias("lb"))
        least = labels.join(near, "node", "left").select("node", "l", F.least("l", F.coalesce("lb", "l")).alias("m"))
        jump = least.select(F.col("node").alias("m"), F.col("m").alias("mm"))
        fresh = materialize(least.join(jump, "m", "left").select("node", F.least("m", F.coalesce("mm", "m")).alias("l"), F.col("l").alias("old")), "labels")
        moved = not fresh.where("l <> old").isEmpty()
        labels = fresh.select("node", "l")
        if not moved:
            return labels.select("node", F.col("l").alias("component"))
    raise RuntimeError("components did not settle")
