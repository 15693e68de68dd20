"""Connected components of a distributed graph."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from recoengine.llm._util import cut


def _jump(hooks: DataFrame) -> DataFrame:
    """Follow every hook one step further."""
    a, b = hooks.alias("a"), hooks.alias("b")
    return a.join(b, F.col("a.to") == F.col("b.hi"), "left").select(F.col("a.hi"), F.coalesce("b.to", "a.to").alias("to"))


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, component) of all nodes that ``edges`` (a, b) name; a component
    is named by its least node.

    Each round hooks every node that has a smaller neighbour to its least one
    (a partial aggregation, so a node of any degree is no hot task), follows
    chains of hooks to their ends by doubling, and goes on with the edges
    between the remaining roots, which are far fewer.  Frames are cut by
    checkpoints, so that joins shuffle both sides anew and Spark can split a
    hot key, and a lost executor costs no earlier round.
    """
    edges = cut(edges.select(F.greatest("a", "b").alias("hi"), F.least("a", "b").alias("lo")).filter("hi <> lo").distinct())
    labels = edges.select(F.col("hi").alias("node")).union(edges.select("lo")).distinct().withColumn("component", F.col("node"))
    while not edges.isEmpty():
        hooks = cut(edges.groupBy("hi").agg(F.min("lo").alias("to")))
        while not hooks.select("to").join(hooks.select("hi"), F.col("to") == F.col("hi"), "left_semi").isEmpty():
            hooks = cut(_jump(hooks))
        h, k, e = hooks.alias("h"), hooks.alias("k"), edges.alias("e")
        moved = e.join(h, F.col("e.hi") == F.col("h.hi")).join(k, F.col("e.lo") == F.col("k.hi"), "left")
        moved = moved.select(F.col("h.to").alias("a"), F.coalesce("k.to", "e.lo").alias("b"))
        edges = cut(moved.select(F.greatest("a", "b").alias("hi"), F.least("a", "b").alias("lo")).filter("hi <> lo").distinct())
        labels = labels.join(hooks, F.col("component") == F.col("hi"), "left").select("node", F.coalesce("to", "component").alias("component"))
    return cut(labels)
