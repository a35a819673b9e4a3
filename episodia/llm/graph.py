"""Connected components of a link table, by joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialize


def components(links: DataFrame) -> DataFrame:
    """(node, root) of every node that isn't its component's smallest. links: (low, high) with low < high.

    Each round hooks every node to the smallest of its lower neighbours, hands its other links down to that level
    (low neighbour to low neighbour) and then lets nodes skip to their parent's parent. All links point down, so the
    rounds end; the number of rounds grows with the logarithm of a component's depth. Only (node, node) pairs move,
    minima are summed up before the shuffle, and the driver sees one count a round.
    """
    links = materialize(links.distinct(), "links")
    while True:
        parents = materialize(links.groupBy("high").agg(F.min("low").alias("low")), "parents")
        handed = links.join(parents.withColumnRenamed("low", "parent"), "high").where("low <> parent").select(F.least("low", "parent").alias("low"), F.greatest("low", "parent").alias("high"))
        up = parents.select(F.col("high").alias("low"), F.col("low").alias("up"))
        skipped = parents.join(up, "low", "left").select(F.coalesce("up", "low").alias("low"), "high", F.col("up").isNotNull().cast("int").alias("open"))
        handed = handed.distinct().withColumn("open", F.lit(1))
        step = materialize(skipped.unionByName(handed.select("low", "high", "open")), "links")
        if step.where("open = 1").isEmpty():
            return step.select(F.col("high").alias("node"), F.col("low").alias("root"))
        links = step.select("low", "high").distinct()
