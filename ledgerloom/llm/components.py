"""Connected components of links between numbered nodes, as joins."""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.blocks import Scratch


def components(scratch: Scratch, links: DataFrame, name: str) -> DataFrame:
    """``node, component``: for each node with a link, the smallest node it can reach.

    Each round gives a node the least label among its neighbours and then its label's own label, so that paths shorten
    by half; it ends when no label changes. Labels are stored between rounds. A hub is a join key that Spark can split.
    """
    both = links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).filter("a <> b").distinct()
    both = scratch.save(both, f"{name}-links")
    labels = scratch.save(both.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("node"), F.least("a", "m").alias("component")), f"{name}-0")
    turn = 0
    while True:
        turn += 1
        near = both.join(labels, both["b"] == labels["node"]).groupBy("a").agg(F.min("component").alias("near"))
        low = labels.join(near, labels["node"] == near["a"]).select("node", "component", F.least("component", "near").alias("low"))
        ahead = labels.select(F.col("node").alias("at"), F.col("component").alias("ahead"))
        moved = low.join(ahead, low["low"] == ahead["at"], "left").select(
            "node", F.least("low", F.coalesce("ahead", "low")).alias("component"), F.col("component").alias("was"))
        moved = scratch.save(moved, f"{name}-{turn}")
        scratch.drop(f"{name}-{turn - 1}")
        if moved.filter("component <> was").isEmpty():
            scratch.drop(f"{name}-links")
            return moved.select("node", "component")
        labels = moved.select("node", "component")
