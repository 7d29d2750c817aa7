"""Connected components."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from encore.llm.common import Scratch


def components(links: DataFrame, left: str = "a", right: str = "b") -> DataFrame:
    """node, component for every node of ``links``; a component is named by its smallest node.

    Every round a node takes the smallest name that the names around it have themselves, and hands it to the node it
    was named by as well, so that a whole tree moves when one of its nodes meets a smaller name; the rounds grow with
    the logarithm of a chain's length. Names are one row per node; what a node meets and what it is handed are reduced
    by partial minimums, so a node with very many links is summed before it moves. Stops when a round changes nothing.

    Rounds are handed on as files: a checkpoint keeps the estimated size of the plan it cuts off, a product over the
    joins of the round, and after r rounds the driver would work with estimates of about 2^r digits.
    """
    scratch = Scratch(links.sparkSession)
    edges = links.select(F.col(left).alias("a"), F.col(right).alias("b"))
    edges = scratch.stored(edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct())
    names = scratch.stored(edges.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("name")))
    while True:
        # a name is always a node's own name or another node's of the component, so it has a row itself
        known = names.join(names.select(F.col("a").alias("name"), F.col("name").alias("far")), "name")
        around = edges.join(known.select(F.col("a").alias("b"), "far"), "b").groupBy("a").agg(F.min("far").alias("near"))
        stepped = known.join(around, "a")
        own = stepped.select("a", F.least("name", "far", "near").alias("next"), F.col("name").alias("old"))
        handed = stepped.select(F.col("name").alias("a"), F.col("near").alias("next"), F.lit(None).alias("old"))
        moved = scratch.stored(
            own.unionByName(handed).groupBy("a").agg(F.min("next").alias("name"), F.min("old").alias("old"))
        )
        changed = moved.where("name <> old").limit(1).count()
        names = moved.select("a", "name")
        if not changed:
            return scratch.finished(names.select(F.col("a").alias("node"), F.col("name").alias("component")))
