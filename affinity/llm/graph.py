"""Connected components of an undirected graph, and joins whose strategy follows measured sizes."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from affinity.session import materialize

BROADCAST_BYTES = 64 << 20


def join_sized(big: DataFrame, small: DataFrame, on, how: str = "inner", row_bytes: int = 64, limit: int = BROADCAST_BYTES) -> DataFrame:
    """``big`` joined with a frozen ``small`` side: held by every task if its counted rows fit the
    limit, else by a shuffle on the key."""
    if small.limit(1 + limit // row_bytes).count() <= limit // row_bytes:
        small = F.broadcast(small)
    return big.join(small, on, how)


def components(edges: DataFrame) -> DataFrame:
    """``node`` and ``root`` (the smallest node of its component) for every node of ``edges`` (a, b).

    Alternates the large-star and small-star steps of Kiveris et al. (2014) until nothing changes. A
    step sends each edge to one place and never lists a node's neighbours, so a node with a great many
    of them costs a partial minimum and a join that can be split. Loops (a = b) are ignored.
    """
    spark = edges.sparkSession
    now = materialize(
        edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges"
    )
    mark = None
    while True:
        both = now.union(now.select("b", "a"))
        least = both.groupBy("a").agg(F.min("b").alias("m")).withColumn("m", F.least("a", "m"))
        large = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        large = materialize(large, "large-star")
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        now = materialize(small.union(least.select("a", "m")).distinct(), "small-star")
        found = now.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if found == mark:
            break
        mark = found
    roots = now.select("b").distinct().select(F.col("b").alias("node"), F.col("b").alias("root"))
    return now.select(F.col("a").alias("node"), F.col("b").alias("root")).union(roots)
