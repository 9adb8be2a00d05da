"""Connected components of an edge list, on Spark alone (alternating large star and small star)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedkit.llm.common import stage


def _state(links: DataFrame) -> tuple:
    return tuple(links.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def components(edges: DataFrame) -> DataFrame:
    """``edges(a, b)`` to ``(node, comp)`` for each node with an edge; ``comp`` is the smallest node reachable.

    Self-loops, repeated edges and either direction are fine; no edges give no rows. Rounds grow with
    the logarithm of the longest chain, and every round is a grouping and a join of the edge list.
    """
    links = stage(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
                  .where("u <> v").distinct(), "links")
    state = _state(links)
    while state[0]:
        both = links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = stage(both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
                      .distinct(), "large")
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        links = stage(small.unionByName(low.select("u", F.col("m").alias("v"))).distinct(), "links")
        before, state = state, _state(links)
        if state == before:
            break
    return links.select(F.col("u").alias("node"), F.col("v").alias("comp")).unionByName(
        links.select(F.col("v").alias("node"), F.col("v").alias("comp")).distinct())
