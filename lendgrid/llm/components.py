"""Connected components of a link table, by alternating star contractions.

Each round points every node at the smallest node it has met (large star: of
all neighbours, small star: of the smaller ones), which halves the depth of
the trees; the number of rounds grows with the logarithm of the longest path.
All state is in tables; a hub's links are minimised by partial aggregation.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from .common import cut


def _contract(links: DataFrame) -> DataFrame:
    """One large star and one small star over links (a > b, distinct)."""
    both = links.select("a", "b").union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    large = (both.join(least, "a").filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
             .distinct())
    small_least = large.groupBy("a").agg(F.min("b").alias("m"))
    joined = large.join(small_least, "a")
    return (joined.select(F.col("b").alias("a"), F.col("m").alias("b"))
            .union(joined.select("a", F.col("m").alias("b")))
            .filter("a != b").distinct())


def connected(links: DataFrame) -> DataFrame:
    """(node, root) of every node that has a link; ``links`` holds (u, v), longs.
    ``root`` is the smallest node of the component."""
    now = cut(links.filter("u != v").select(F.greatest("u", "v").alias("a"), F.least("u", "v").alias("b")).distinct(), "links")
    state = None
    while True:
        # The set of links no longer changes when every node has one link, to a node without any above it.
        after = now.agg(F.count("*").alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("h")).first()
        if state == after or not after["n"]:
            break
        state, now = after, cut(_contract(now), "links")
    nodes = now.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return nodes.union(now.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
