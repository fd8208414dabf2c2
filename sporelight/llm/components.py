"""Connected components by alternating large-star and small-star rounds.

Each round is a few shuffles of the links, with partial aggregation before
every one, and ends in a written table; hubs are spread by the skew handling of
the joins.  Only a count and a checksum of the links come to the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .store import written


def components(links: DataFrame) -> DataFrame:
    """``node, component`` (the smallest node reachable) for every node that has a link; ``links``: a, b (long)."""
    edges = links.where("a IS NOT NULL AND b IS NOT NULL AND a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    edges, before = written(edges, "edges"), None
    while True:
        mark = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))).first()
        if mark[0] == 0 or mark == before:
            break
        before = mark
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        lower = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(lower, "u").select(F.explode(F.array(F.struct(F.col("v").alias("u"), F.col("m").alias("v")), F.struct("u", F.col("m").alias("v")))).alias("e")).select("e.u", "e.v")
        edges = written(small.where("u <> v").distinct(), "edges")
    own = edges.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return own.union(edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
