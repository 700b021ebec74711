"""Connected components of a graph given as a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetpulse.llm.common import stored


def components(links: DataFrame) -> DataFrame:
    """``node, component`` for every node of ``links(a, b)``; a component is its smallest node.

    Labels begin as the nodes. In each round every label with a smaller label
    beside it is hooked to the smallest one, and labels move on by two hooks, so
    that chains shrink by a constant share. Links are then drawn between the new
    labels; those within one label go, so rounds shrink. Hooks and links are
    written tables; nothing but emptiness reaches the driver. Node ids must not
    be null.
    """
    both = links.select("a", "b").union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    between = stored(both.where("a <> b"), "links")
    labels = between.select(F.col("a").alias("node")).distinct().withColumn("component", F.col("node"))
    while True:
        hooks = between.groupBy("a").agg(F.min("b").alias("to")).where("to < a")
        onward = hooks.select(F.col("a").alias("to"), F.col("to").alias("next"))
        moves = hooks.join(onward, "to", "left").select(F.col("a").alias("old"), F.coalesce("next", "to").alias("new"))
        moves = stored(moves, "moves")
        if moves.isEmpty():
            return stored(labels, "labels")
        labels = labels.join(moves.withColumnRenamed("old", "component"), "component", "left").select(
            "node", F.coalesce("new", "component").alias("component")
        )
        for side in ("a", "b"):
            between = between.join(moves.withColumnRenamed("old", side), side, "left").withColumn(
                side, F.coalesce("new", side)
            ).drop("new")
        between = stored(between.where("a <> b"), "links")
