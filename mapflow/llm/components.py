"""Connected components of a link table, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mapflow.llm.common import stored


def _both_ways(links: DataFrame) -> DataFrame:
    return links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))


def _smallest(links: DataFrame) -> DataFrame:
    """Per node `a` the smallest of itself and its neighbours `b`."""
    return links.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))


def components(links: DataFrame) -> DataFrame:
    """`node, component` (the smallest node reachable) for every node of links `a, b`.

    Each round ties every node's larger neighbours to its smallest one, then every
    node and its smaller neighbours; it ends when the table no longer changes, after
    about a logarithm of the longest path. Links stay linear in number, are only ever
    aggregated or joined, and are written to the shared folder after each round.
    """
    now = stored(links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "links")
    before = None
    while True:
        mark = now.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")), F.lit(0))).first()
        if mark == before:
            break
        before = mark
        each = _both_ways(now)
        large = each.join(_smallest(each), "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = stored(large.distinct(), "large-star")  # every row has a > b
        least = _smallest(large)
        small = large.join(least, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        now = stored(small.unionByName(least.select("a", F.col("m").alias("b"))).where("a <> b").distinct(), "small-star")
    # Now every row points from a node straight to its component.
    return now.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(
        now.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    )
