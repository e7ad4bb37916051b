"""Connected components of an undirected graph given as edges, all in Spark.

Alternating large-star / small-star steps: every step is one grouped minimum and
one join on the vertex, hot vertices pre-aggregate before the shuffle, and each
step's edges are checkpointed.  Nothing is collected but one count and one
checksum per step.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskframe.llm._common import cut


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """``edges`` (a, b).  Large star links every greater neighbour of a vertex to the
    least of its neighbourhood; small star links the smaller ones and the vertex."""
    if large:
        n = edges.select(F.col("a").alias("u"), F.col("b").alias("v")).union(edges.select("b", "a"))
    else:
        n = edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
    least = n.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))
    linked = n.join(least, "u")
    if large:
        out = linked.filter("v > u").select(F.col("v").alias("a"), F.col("m").alias("b"))
    else:
        out = linked.select(F.col("v").alias("a"), F.col("m").alias("b")).union(least.select("u", "m"))
    return out.filter("a <> b").distinct()


def connected_components(edges: DataFrame) -> DataFrame:
    """``edges`` (a long, b long) -> (vertex, root): the least vertex reachable, for
    every vertex that has an edge.  Nulls, loops and repeated edges are ignored."""
    edges = cut(edges.select("a", "b").filter("a is not null and b is not null and a <> b").distinct())
    seen = None
    while True:
        edges = cut(_star(_star(edges, large=True), large=False))
        state = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if state == seen or state[0] == 0:
            return edges.select(F.col("a").alias("vertex"), F.col("b").alias("root")).union(
                edges.select("b", "b").distinct())
        seen = state
