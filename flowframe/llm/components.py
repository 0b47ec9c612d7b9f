"""Connected components by min-label propagation with pointer jumping, in DataFrame joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import discard, staged


def components(edges: DataFrame) -> DataFrame:
    """(node, label) of every node of edges (a, b): the least node of its component.

    Each round takes the least label next door, then the label of that label, so long chains shorten by doubling. A node
    with very many edges is pre-aggregated in each task.
    """
    both = staged(edges.select(F.col("a").alias("node"), F.col("b").alias("other")).unionByName(edges.select(F.col("b").alias("node"), F.col("a").alias("other"))).distinct(), "cc-edges")
    labels = staged(both.groupBy("node").agg(F.min("other").alias("m")).select("node", F.least("node", "m").alias("label")), "cc-labels")
    while True:
        near = both.join(labels.select(F.col("node").alias("other"), "label"), "other").groupBy("node").agg(F.min("label").alias("m"))
        low = labels.select("node", "label").join(near, "node", "left").select("node", F.col("label").alias("was"), F.least("label", F.coalesce("m", "label")).alias("label"))
        up = low.select(F.col("node").alias("label"), F.col("label").alias("top"))
        jumped = low.join(up, "label", "left").select("node", "was", F.least(F.col("label"), F.coalesce("top", "label")).alias("label"))
        found = staged(jumped, "cc-labels")
        changed = found.where("was <> label").limit(1).count()
        discard(labels)
        if not changed:
            discard(both)
            out = found.select("node", "label")
            out.staged_at = found.staged_at
            return out
        labels = found
