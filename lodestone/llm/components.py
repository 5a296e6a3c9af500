"""Connected components by alternating large-star and small-star joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialise


def components(edges: DataFrame) -> DataFrame:
    """``edges`` (a, b) to (node, root): each node that has an edge, but for roots themselves, with the least node it reaches.

    Each round joins the edges with the least neighbour of their ends and is written to the shared
    folder; the number of rounds grows with the logarithm of the longest path. A hot node's edges are
    aggregated before the shuffle and stay spread over tasks.
    """
    least, most = F.least("a", "b"), F.greatest("a", "b")
    now = materialise(edges.filter("a <> b").select(most.alias("u"), least.alias("v")).distinct(), "links")
    mark = lambda e: tuple(e.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))).first())
    before = None
    while (seen := mark(now)) != before:
        before = seen
        both = now.union(now.select("v", "u"))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(low, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v").distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))  # here v < u
        small = large.join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).union(low.select("u", "m"))
        now = materialise(small.filter("u <> v").distinct(), "links")
    return now.select(F.col("u").alias("node"), F.col("v").alias("root"))
