"""Connected components of links, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardgrid.llm import common


def connected(links: DataFrame) -> DataFrame:
    """(node, component) for every node of `links` (a, b): the smallest node that can be reached.

    Each round hangs every node's greater neighbours, then its lesser ones, on its smallest neighbour, until
    nothing changes; rounds grow with the logarithm of the longest path. A round's links are written to the
    shared folder. Empty links give no rows; links of a node with itself do not matter.
    """
    edges = common.stored(links.filter("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "edges")
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        lowest = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        # greater neighbours to the smallest
        large = both.filter("v > u").join(lowest.hint("merge"), "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.filter("u <> v").distinct()
        # lesser neighbours and the node itself to the smallest
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least.hint("merge"), "u").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(least.withColumnRenamed("m", "v"))
        following = common.stored(small.filter("u <> v").distinct(), "edges")
        if following.count() == edges.count() and following.join(edges.hint("merge"), ["u", "v"], "left_anti").isEmpty():
            break
        edges = following
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(edges.select(F.col("v").alias("node"), F.col("v").alias("component"))).distinct()
