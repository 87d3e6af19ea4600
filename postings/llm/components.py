"""Connected components by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import kept


def _mark(edges: DataFrame) -> tuple[int, int]:
    row = edges.agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("hi", "lo") % F.lit(1_000_003)).alias("s")).first()
    return row.n, row.s or 0


def components(edges: DataFrame) -> DataFrame:
    """(node, component) for the nodes of ``edges`` (u, v): the least node that can be reached.

    The least node of a component has no row. Each round links every node's greater
    neighbours, then its lesser ones, to the least it knows; edges never get more. Rounds end
    when nothing changes, after about the logarithm of the longest path.
    """
    edges = edges.filter("u <> v").select(F.greatest("u", "v").alias("hi"), F.least("u", "v").alias("lo")).distinct()
    edges = kept(edges)
    mark = _mark(edges)
    while True:
        both = edges.select(F.col("hi").alias("u"), F.col("lo").alias("v")).union(edges.select(F.col("lo").alias("u"), F.col("hi").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.filter("v > u").join(least, "u").filter("v <> m").select(F.col("v").alias("hi"), F.col("m").alias("lo")).distinct()
        lowest = large.groupBy("hi").agg(F.min("lo").alias("m"))
        small = large.join(lowest, "hi").select(F.explode(F.array(F.struct("hi", F.col("m").alias("lo")), F.struct(F.col("lo").alias("hi"), F.col("m").alias("lo")))).alias("e"))
        edges = kept(small.select("e.*").filter("hi <> lo").distinct())
        after = _mark(edges)
        if after == mark:
            return edges.select(F.col("hi").alias("node"), F.col("lo").alias("component"))
        mark = after
