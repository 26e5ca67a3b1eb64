"""Connected components of an edge table by least-label propagation with
pointer jumping; labels live in tables of the shared folder, never on the driver."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from sparkmart.llm.common import written


def components(edges: DataFrame, max_rounds: int = 100) -> DataFrame:
    """(node, label) for every node of ``edges`` (a, b bigint, not null);
    ``label`` is the least node of the component. A node's neighbours are
    reduced to their least label before they meet (map-side), so a node with
    very many neighbours costs its edges and no more."""
    both = edges.where("a <> b").select(F.inline(F.array(F.struct("a", "b"), F.struct(F.col("b").alias("a"), F.col("a").alias("b")))))
    both = written(both.distinct(), "edges")
    labels = written(both.groupBy("a").agg(F.min("b").alias("m")).select(
        F.col("a").alias("node"), F.least("a", "m").alias("label")), "labels")
    own = F.col("label").alias("own")
    for _ in range(max_rounds):
        near = both.join(labels, both["b"] == labels["node"]).select(
            F.col("a").alias("node"), "label", F.lit(None).cast("bigint").alias("own"))
        step = near.unionAll(labels.select("node", "label", own)).groupBy("node").agg(
            F.min("label").alias("next"), F.max("own").alias("label"))
        up = labels.select(F.col("node").alias("next"), F.col("label").alias("top"))
        moved = Observation()  # counted as the labels are written: a job and a plan less for the driver in each round
        labels = written(step.join(up, "next").select("node", F.least("next", "top").alias("new"), "label").observe(
            moved, F.count_if(F.col("label") != F.col("new")).alias("n")).select("node", F.col("new").alias("label")), "labels")
        if not moved.get["n"]:
            return labels
    raise RuntimeError(f"components did not settle in {max_rounds} rounds")
