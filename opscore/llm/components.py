"""Connected components of a table of links, by alternating large and small stars.

Every round sends the larger neighbours of each node to its smallest one (large star),
then the smaller ones (small star).  Both are a partial ``min`` and a join on the
node, so a node with very many links is split like any skewed join key.  The number of
rounds grows with the logarithm of the longest chain; each round is a written
table, so a lost executor costs one round at most.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .scratch import drop, stored


def _signature(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b"))).first())


def components(links: DataFrame) -> DataFrame:
    """id, component (the smallest id reachable) of every id in ``links`` (columns a, b) but the smallest ones.

    A round's tables go when the next one is written; the last is the result's (``scratch.drop`` takes it).
    """
    edges = stored(links.filter("a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(),
                   "links")
    before = None
    while (now := _signature(edges)) != before:
        before = now
        both = edges.unionAll(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.filter("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        large = stored(large, "large-star")
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").filter("b != m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        done = edges
        edges = stored(small.unionAll(least.select("a", F.col("m").alias("b"))).distinct(), "small-star")
        drop(done)
        drop(large)
    found = edges.select(F.col("a").alias("id"), F.col("b").alias("component"))
    found.opscore_path = edges.opscore_path
    return found
