"""Connected components of a graph given as a table of edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cotrend.llm.common import stored


def components(edges: DataFrame) -> DataFrame:
    """``node``, ``label``: the smallest node that can be reached, for every node of an edge (``a``, ``b``).

    Each round takes the smallest label among the neighbours and then the label of that label, so the number of rounds
    follows the logarithm of a component's width. Rounds are written to the shared folder; one number returns to the driver.
    """
    forth = edges.select("a", "b").where(F.col("a") != F.col("b"))
    both = stored(forth.union(forth.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "edges")
    first = both.groupBy("a").agg(F.min("b").alias("b"))
    labels = stored(first.select(F.col("a").alias("node"), F.least("a", "b").alias("label")), "labels")
    while True:
        known = labels.select(F.col("node").alias("b"), F.col("label").alias("seen"))
        near = both.join(known, "b").groupBy(F.col("a").alias("node")).agg(F.min("seen").alias("seen"))
        lower = labels.join(near, "node").select("node", F.col("label").alias("old"), F.least("label", "seen").alias("label"))
        jump = labels.select(F.col("node").alias("label"), F.col("label").alias("further"))
        moved = lower.join(jump, "label").select("node", "old", F.least("label", "further").alias("label"))
        after = stored(moved, "labels")
        if after.where(F.col("label") < F.col("old")).isEmpty():
            return after.select("node", "label")
        labels = after.select("node", "label")
