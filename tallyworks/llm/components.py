"""Connected components of a graph given as a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyworks.llm import common


def roots(links: DataFrame) -> DataFrame:
    """(node, root) for every node on a link: the smallest node of its component.

    Alternates two steps until no link changes: every larger neighbour of a node is linked
    to its smallest neighbour, then every smaller one. Each round is two hash aggregations
    and joins over the links; a hub is combined before the shuffle and split by the skew
    handling of the join. The number of rounds grows with the logarithm of the graph.

    ``links`` holds two long columns a and b; loops and repeated links are allowed.
    """
    edges = common.written(_oriented(links.select("a", "b")), "links")
    state = _digest(edges)
    while state[0]:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        lowest = both.groupBy("a").agg(F.min("b").alias("low"))
        large = both.filter("b > a").join(lowest, "a").select(F.col("b").alias("a"), F.least("a", "low").alias("b"))
        large = _oriented(large)
        lowest = large.groupBy("a").agg(F.min("b").alias("low"))
        near = large.join(lowest, "a")
        small = near.select(F.col("b").alias("a"), F.col("low").alias("b"))
        small = _oriented(small.unionByName(lowest.select("a", F.col("low").alias("b"))))
        edges = common.written(small, "links")
        after = _digest(edges)
        if after == state:
            break
        state = after
    stars = edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return stars.unionByName(stars.select(F.col("root").alias("node"), "root").distinct())


def _oriented(links: DataFrame) -> DataFrame:
    """Each link once, from the larger node to the smaller."""
    high, low = F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")
    return links.filter("a != b").select(high, low).distinct()


def _digest(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.coalesce(F.bit_xor(F.xxhash64("a", "b")), F.lit(0))).first())
