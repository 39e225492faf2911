"""Connected components of a link table, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from citewell.session import checkpointed


def _mark(links: DataFrame) -> tuple:
    return tuple(links.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """node, root for every node that has a link: the smallest node it can reach.

    Links are undirected; repeated links and links to itself don't matter, null ends are left
    out.  Each round joins every node with the smallest neighbour of its neighbours and is
    checkpointed; a node with very many links is never gathered, only its minimum.  Rounds
    grow with the logarithm of the longest chain.
    """
    now = (
        links.where(F.col(a) != F.col(b))
        .select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).distinct()
    )
    now = checkpointed(now)
    mark = _mark(now)
    while mark[0]:
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        lowest = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.where("v > u").join(lowest, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        lowest = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (
            large.join(lowest, "u").where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
            .unionByName(lowest.select("u", F.col("m").alias("v"))).distinct()
        )
        now = checkpointed(small)
        before, mark = mark, _mark(now)
        if mark == before:
            break
    return now.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(
        now.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    )
