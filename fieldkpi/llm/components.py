"""Connected components of an edge table by alternating large and small stars.

Each round rewrites the edges so that every node points at the smallest node it
knows; rounds end when every node points at one that points at none, which takes
about the logarithm of the longest path. Edges that are so from the start take no
round. Per-node minima are partial aggregations, so a hub costs a row per task; the
rounds' tables lie in the shared checkpoint folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldkpi.llm.common import stored


def _state(e: DataFrame):
    """(edges, nodes that point at more than one node, or at one and are pointed at)."""
    ends = e.select(F.col("hi").alias("u"), F.lit(1).alias("up"), F.lit(0).alias("down")).unionAll(
        e.select(F.col("lo").alias("u"), F.lit(0).alias("up"), F.lit(1).alias("down")))
    nodes = ends.groupBy("u").agg(F.sum("up").alias("up"), F.max("down").alias("down"))
    return nodes.agg(F.coalesce(F.sum("up"), F.lit(0)), F.count_if((F.col("up") > 1) | ((F.col("up") == 1) & (F.col("down") == 1)))).first()


def components(edges: DataFrame) -> DataFrame:
    """``edges``: columns ``a``, ``b`` of one type, cheap to read more than once.
    Returns ``node`` and its ``component``, the smallest node reachable, for nodes
    other than that one. Loops and null ends are ignored; an empty table gives an
    empty table."""
    e = edges.where(F.col("a") != F.col("b")).select(F.greatest("a", "b").alias("hi"), F.least("a", "b").alias("lo"))
    n, crossed = _state(e)
    while crossed:
        both = e.select(F.col("hi").alias("u"), F.col("lo").alias("v")).unionAll(e.select(F.col("lo").alias("u"), F.col("hi").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(low, "u").where("v > u").select(F.col("v").alias("hi"), F.col("m").alias("lo"))
        own = large.groupBy("hi").agg(F.min("lo").alias("m"))
        small = (large.join(own, "hi").select(F.col("lo").alias("hi"), F.col("m").alias("lo")).where("hi <> lo")
                 .unionAll(own.select("hi", F.col("m").alias("lo"))).distinct())
        e = stored(small, "cc", rows=2 * n)
        n, crossed = _state(e)
    return e.select(F.col("hi").alias("node"), F.col("lo").alias("component"))
