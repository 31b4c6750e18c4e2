"""Connected components of links that never leave the cluster."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyspan.llm.common import written


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """node, root for every node with a link to another; root is the smallest node it can reach.

    Each round lets every node hand its neighbours on to the smallest of them,
    first the larger neighbours, then the smaller ones, until all links lead to
    roots; the number of rounds grows with the logarithm of the longest path.
    Rounds are written tables, so a lost executor costs one round at most; the
    minima are too, so that a join of a hub's many links can be split.
    Null and self links count for nothing.
    """
    edges = written(
        links.where(F.col(a) != F.col(b)).select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).distinct(), "links"
    )
    state = None
    while True:
        both = edges.union(edges.select(F.col("v"), F.col("u")))
        least = both.groupBy(F.col("u").alias("n")).agg(F.min("v").alias("m")).select("n", F.least("n", "m").alias("m"))
        met = both.join(written(least, "least"), F.col("u") == F.col("n"))
        large = written(met.where("v > u and v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct(), "large")
        least = large.groupBy(F.col("u").alias("n")).agg(F.min("v").alias("m"))
        met = large.join(written(least, "least"), F.col("u") == F.col("n"))
        handed = met.select("u", F.col("m").alias("v")).union(met.select(F.col("v").alias("u"), F.col("m").alias("v")))
        edges = written(handed.where("u <> v").distinct(), "links")
        now = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == state:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
        state = now
