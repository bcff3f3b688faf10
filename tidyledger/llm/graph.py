"""Connected components of a distributed edge list."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidyledger.llm.common import checkpointed
from tidyledger.llm.skew import lookup


def _both_ways(edges: DataFrame) -> DataFrame:
    return edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))


def _large_star(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is linked to the node's least neighbour."""
    both = _both_ways(edges)
    least = both.groupBy("a").agg(F.min("b").alias("m"), F.count_if(F.col("b") > F.col("a")).alias("n"))
    least = checkpointed(least.filter("n > 0").select("a", F.least("a", "m").alias("m"), "n"))
    linked = lookup(both.filter("b > a"), least, "a")
    return linked.select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """A node and its smaller neighbours are linked to the least of them. Has a > b."""
    least = checkpointed(edges.groupBy("a").agg(F.min("b").alias("m"), F.count("*").alias("n")))
    linked = lookup(edges, least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    own = least.select("a", F.col("m").alias("b"))
    return linked.filter("a <> b").unionByName(own).distinct()


def components(edges: DataFrame) -> DataFrame:
    """`node`, `root`: for every node of the edges (a, b) the least node it reaches.

    Alternates the two star operations until nothing changes, with a checkpoint
    after each step; the driver sees only a count and a checksum. The node of a
    large group meets its members without a shuffle of them. A root has a row of
    its own. No edges give no rows.
    """
    now = checkpointed(
        edges.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    )
    seen = None
    while True:
        state = now.agg(F.count("*"), F.sum(F.hash("a", "b").cast("long"))).first()
        if state == seen or not state[0]:
            break
        seen = state
        now = checkpointed(_small_star(checkpointed(_large_star(now))))
    roots = now.select("b").distinct()
    return now.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(
        roots.select(F.col("b").alias("node"), F.col("b").alias("root"))
    )
