"""Connected components of an edge table, with hot vertices dealt over tasks.

Alternating large-star and small-star rounds (every vertex links to the smallest vertex
it knows) until nothing changes: O(log^2 n) rounds, each written to the shared folder.
A vertex with very many neighbours is dealt over tasks by ``salted_join``; minima are
taken with partial aggregation. Nothing but counts reaches the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from civicmart.llm.common import salted_join, scratch, stored


def _star(pairs: DataFrame, name: str) -> DataFrame:
    """Of directed pairs (u, v): each with the minimum of u and all its v."""
    spark = pairs.sparkSession
    pairs = stored(pairs, scratch(spark, f"cc-{name}-pairs"))
    least = stored(pairs.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"),
                                          F.count(F.lit(1)).alias("n")),
                   scratch(spark, f"cc-{name}-min"))
    total = least.agg(F.sum("n")).first()[0] or 0
    return salted_join(pairs, least, ["u"], "n", total, F.xxhash64("v"), "inner")


def components(edges: DataFrame) -> DataFrame:
    """(node, root) of every node in ``edges`` (a, b); root is the component's smallest node."""
    spark = edges.sparkSession
    links = stored(edges.where("a <> b").select(F.greatest("a", "b").alias("u"),
                                                F.least("a", "b").alias("v")).distinct(),
                   scratch(spark, "cc-links"))
    before = None
    while True:
        both = links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = (_star(both, "large").where(F.col("v") > F.col("u"))
                 .select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct())
        small = _star(large, "small")
        links = (small.select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .unionByName(small.select(F.col("u"), F.col("m").alias("v")))
                 .where("u <> v").distinct())
        links = stored(links, scratch(spark, "cc-links"))
        now = tuple(links.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")))
                    .first())
        if now == before:
            break
        before = now
    return links.select(F.col("u").alias("node"), F.col("v").alias("root"))
