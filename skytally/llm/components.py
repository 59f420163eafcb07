"""Connected components by label propagation with pointer jumping, all in joins and aggregates."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skytally.llm.storage import stored


def components(edges: DataFrame) -> DataFrame:
    """Edges (a, b), undirected, to rows (node, component): the smallest node that can be reached.

    Every round takes the smallest label among the neighbours and then the label of the label, so rounds grow with
    the logarithm of the longest chain. Labels are written between rounds: both sides of each join are then scans
    behind a shuffle, which adaptive execution splits where one node has very many neighbours. Edges with a null
    end are ignored; nodes without edges don't appear; repeated edges and loops change nothing.
    """
    known = edges.select("a", "b").dropna()
    both = stored(known.union(known.select("b", "a")).distinct(), "edges")
    labels = stored(
        both.groupBy("a")
        .agg(F.min("b").alias("low"))
        .select(F.col("a").alias("node"), F.least("a", "low").alias("label")),
        "labels",
    )
    while True:
        near = labels.select(F.col("node").alias("b"), F.col("label").alias("near"))
        lowest = both.join(near, "b").groupBy(F.col("a").alias("node")).agg(F.min("near").alias("near"))
        lowered = stored(
            labels.join(lowest, "node").select("node", "label", F.least("label", "near").alias("lower")), "lowered"
        )
        jump = lowered.select(F.col("node").alias("lower"), F.col("lower").alias("lowest"))
        after = stored(lowered.join(jump, "lower").select("node", "label", "lowest"), "jumped")
        labels = after.select("node", F.col("lowest").alias("label"))
        if after.filter("label <> lowest").isEmpty():
            return labels.withColumnRenamed("label", "component")
