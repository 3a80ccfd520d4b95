"""Connected components of a table of links, by repeated joins (large-star, small-star)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orgmill.llm.common import stored


def components(links: DataFrame, max_rounds: int = 60) -> DataFrame:
    """node, component (the smallest node reachable) for every node of links (a, b: long), which may repeat.

    Each round hangs neighbours under the smallest one they see, once over the larger and once over the smaller
    neighbours; the number of rounds grows with the logarithm of the diameter. Minima are pre-aggregated, no
    neighbourhood is gathered, and each round is written to the shared folder. Raises if it has not ended in time.
    """
    edges = stored(links.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "links")
    before = None
    for _ in range(max_rounds):
        both = edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("m", "u").alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        joined = large.join(least, "u")
        small = joined.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).union(least.select("u", F.col("m").alias("v")))
        edges = stored(small.distinct(), "links")
        now = edges.agg(F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("s")).first()
        if now == before:
            break
        before = now
    else:
        raise RuntimeError("connected components did not settle")
    roots = edges.select(F.col("v").alias("node"), F.col("v").alias("component"))
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).union(roots).distinct()
