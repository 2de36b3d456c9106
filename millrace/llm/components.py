"""Connected components of an edge table, without collecting edges or labels."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.shared import discard, stored

MAX_ROUNDS = 40


def connected(edges: DataFrame) -> DataFrame:
    """(node, label) for every node of edges (a, b); label is the least node of its component.

    Each round takes the least label among neighbours and then the label's own
    label, so that paths shorten by half; labels are stored between rounds. Least
    values are combined before the shuffle, so a node with many edges costs little.
    """
    both = stored(edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "edges")
    labels = stored(both.groupBy(F.col("a").alias("node")).agg(F.least(F.col("node"), F.min("b")).alias("label")), "labels")
    for _ in range(MAX_ROUNDS):
        near = both.join(labels.withColumnRenamed("node", "b"), "b").groupBy(F.col("a").alias("node")).agg(F.min("label").alias("seen"))
        stepped = labels.join(near, "node", "left").select("node", F.col("label").alias("was"), F.least("label", "seen").alias("step"))
        up = labels.select(F.col("node").alias("step"), F.col("label").alias("up"))
        jumped = stored(stepped.join(up, "step", "left").select("node", F.least("step", "up").alias("label"), "was"), "labels")
        changed = jumped.where("label <> was").limit(1).count()
        discard(labels)
        labels = jumped.select("node", "label")
        labels.stored_at = jumped.stored_at
        if not changed:
            discard(both)
            return labels
    raise RuntimeError("components did not settle")
