"""Connected components of a graph whose nodes may have any number of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siftgate.llm.common import stored, with_groups


def _linked(links: DataFrame, larger: bool) -> DataFrame:
    """Links every neighbour of a node (only larger, or only smaller ones) to the least one it knows."""
    pairs = links if not larger else links.union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = pairs.groupBy("a").agg(F.min("b").alias("_least"), F.count("*").alias("_links"))
    least = least.withColumn("_least", F.least("a", "_least"))
    found = with_groups(pairs, stored(least, "stars"), ["a"], "_links", F.col("b"))
    if larger:
        moved = found.filter("b > a").select(F.col("b").alias("a"), F.col("_least").alias("b"))
    else:
        moved = found.select(F.col("b").alias("a"), F.col("_least").alias("b"))
        moved = moved.union(least.select("a", F.col("_least").alias("b")))
    return stored(moved.filter("a > b").distinct(), "links")


def components(links: DataFrame) -> DataFrame:
    """``node, root``: the smallest node reachable, for every node of ``a, b`` that is not its own root.

    Large and small stars by turns: each round hangs the larger neighbours of a node, then the
    smaller ones, on the least. A round is two map-side combined minima and two joins in which nodes
    with many links are spread; the number of rounds grows with the logarithm of the longest chain.
    """
    current = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter("a > b").distinct()
    current = stored(current, "links")
    before = None
    while True:
        now = current.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == before or now[0] == 0:
            return current.select(F.col("a").alias("node"), F.col("b").alias("root"))
        before = now
        current = _linked(_linked(current, True), False)
