"""Union, deduplication and per-query caps for collected records."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window, functions as F

from citewell.functions.keys import dedup_identity


def union_sources(*sources: DataFrame) -> DataFrame:
    """Bag union by column name; columns a source lacks are null."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), sources)


def in_source_order(*sources: DataFrame) -> DataFrame:
    """Bag union whose ``_seq`` sorts the rows of an earlier source before those of a later one.

    Sources that number their rows alike keep that order within; ``_seq`` becomes (source, seq).
    """
    ranked = [s.withColumn("_seq", F.struct(F.lit(i).alias("source"), F.col("_seq").alias("seq"))) for i, s in enumerate(sources)]
    return union_sources(*ranked)


def first_by_identity(records: DataFrame) -> DataFrame:
    """Keeps the first arrival (lowest ``_seq``) of each identity.

    ``min_by`` combines inside each task, so a heavily repeated identity shuffles at
    most one row per task.
    """
    identity = dedup_identity(F.col("dblp_key"), F.col("doi"), F.col("title"))
    firsts = records.groupBy(identity.alias("_identity")).agg(F.min_by(F.struct(*records.columns), "_seq").alias("_row"))
    return firsts.select("_row.*")


def cap_per_query(records: DataFrame, limit: int, query: str = "query") -> DataFrame:
    """First ``limit`` records of each query in arrival order."""
    arrival = Window.partitionBy(query).orderBy("_seq")
    return records.withColumn("_n", F.row_number().over(arrival)).where(F.col("_n") <= limit).drop("_n")


def first_source_wins(hits: DataFrame, query: str = "query") -> DataFrame:
    """Per query, only the rows of the source with the lowest ``priority`` that has any.

    The winning priority is a small aggregate joined back, so a query holding a large
    share of all rows is never gathered in one window partition.
    """
    winners = hits.groupBy(query).agg(F.min("priority").alias("priority"))
    return hits.join(winners, [query, "priority"], "left_semi")


def empty_sources(queries: DataFrame, hits: DataFrame, sources: dict[str, int], query: str = "query") -> DataFrame:
    """(query, source) pairs for which a source of better priority than the winner gave nothing.

    Queries no source answers list every source.
    """
    winners = hits.groupBy(query).agg(F.min("priority").alias("won"))
    ranked = F.array(*[F.struct(F.lit(s).alias("source"), F.lit(p).alias("priority")) for s, p in sources.items()])
    listed = queries.select(query).distinct().join(winners, query, "left")
    return listed.select(query, "won", F.explode(ranked).alias("s")).where(
        F.col("won").isNull() | (F.col("s.priority") < F.col("won"))
    ).select(query, F.col("s.source").alias("source"))
