"""Connected components of a graph in a table of links, by alternating large and small stars."""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.common import discard, staged


def _linked_to_minimum(links: DataFrame, least: DataFrame) -> DataFrame:
    """(v, least of u) for every link (u, v), from staged minima, so that both sides of the join are
    plain shuffles and a hub's links can be split over tasks."""
    return links.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))


def _large_star(links: DataFrame) -> DataFrame:
    both = links.select("u", "v").union(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = staged(both.groupBy("u").agg(F.min("v").alias("m"))
                   .select("u", F.least("u", "m").alias("m")))
    out = staged(_linked_to_minimum(both.filter("v > u"), least).filter("u > v").distinct())
    discard(least)
    return out


def _small_star(links: DataFrame) -> DataFrame:
    least = staged(links.groupBy("u").agg(F.min("v").alias("m")))
    moved = _linked_to_minimum(links, least).filter("u > v")
    out = staged(moved.union(least.select("u", F.col("m").alias("v"))).distinct())
    discard(least)
    return out


def connected(links: DataFrame) -> DataFrame:
    """(node, root) for every node of `links` (u, v) that isn't itself the root, the smallest node
    that it reaches. Links in either direction, repeated, or from a node to itself may occur; a
    link with a null end counts for nothing. Each round is staged, and the driver sees a count and
    a hash of it only; rounds grow with the logarithm of the longest path."""
    links = staged(links.filter("u <> v")
                   .select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
                   .distinct())
    seen = None
    while True:
        mark = links.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first()
        if mark == seen or not mark[0]:
            return links.select(F.col("u").alias("node"), F.col("v").alias("root"))
        large = _large_star(links)
        small = _small_star(large)
        discard(links, large)
        seen, links = mark, small
