"""Rebuild of the derived tables from the catalog."""

from __future__ import annotations

import uuid
from collections.abc import Iterable
from dataclasses import dataclass, fields
from datetime import datetime, timezone

from pyspark.sql import DataFrame, functions as F

from citewell.functions.vocab import STOP_WORDS
from citewell.operators.keywords import keyword_links, paper_vector, rank_keywords, term_stats
from citewell.operators.terms import VOCABULARY_SIZE, weigh
from citewell.operators.topics import STARTS, assign, cluster_count, top_topics, topic_clusters
from citewell.operators.trends import trend_stats
from citewell import schemas


@dataclass(frozen=True)
class Derived:
    """The five derived tables and the run's metadata row."""

    topic_clusters: DataFrame
    paper_analysis: DataFrame
    keyword_stats: DataFrame
    keyword_papers: DataFrame
    trend_stats: DataFrame
    analysis_meta: DataFrame

    def tables(self) -> dict[str, DataFrame]:
        return {f.name: getattr(self, f.name) for f in fields(self)}


SCHEMAS = {
    "topic_clusters": schemas.TOPIC_CLUSTERS,
    "paper_analysis": schemas.PAPER_ANALYSIS,
    "keyword_stats": schemas.KEYWORD_STATS,
    "keyword_papers": schemas.KEYWORD_PAPERS,
    "trend_stats": schemas.TREND_STATS,
    "analysis_meta": schemas.ANALYSIS_META,
}


def _typed(name: str, df: DataFrame) -> DataFrame:
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in SCHEMAS[name]])


def run_metadata(papers: DataFrame, run_at: str, clusters: int, paper_count: int) -> DataFrame:
    return papers.sparkSession.range(1).select(
        F.lit(run_at).cast("timestamp").alias("run_at"),
        F.lit(paper_count).cast("bigint").alias("paper_count"),
        F.lit(clusters).alias("cluster_count"),
        F.lit("tfidf").alias("vectorizer"),
        F.lit("kmeans").alias("clusterer"),
    )


def refresh(
    papers: DataFrame,
    run_at: str | None = None,
    stop_words: Iterable[str] = STOP_WORDS,
    vocabulary_size: int = VOCABULARY_SIZE,
    starts: int = STARTS,
) -> Derived:
    """Derive topics, vectors, keywords, links and trends.

    An empty catalog gives empty tables and a 0/0 metadata row; a corpus without any
    term gives empty tables too, with the paper count kept.
    """
    run_at = run_at or datetime.now(timezone.utc).strftime("%Y-%m-%d %H:%M:%S.%f")
    at = F.lit(run_at).cast("timestamp")
    corpus = weigh(papers, stop_words, vocabulary_size)
    clusters = cluster_count(corpus.paper_count) if corpus.paper_count else 0
    meta = run_metadata(papers, run_at, clusters, corpus.paper_count)
    if not corpus.terms:
        empty = {n: papers.sparkSession.createDataFrame([], s) for n, s in SCHEMAS.items() if n != "analysis_meta"}
        return Derived(**empty, analysis_meta=_typed("analysis_meta", meta))

    assigned = assign(corpus, starts)
    keywords = rank_keywords(term_stats(corpus), at)
    chosen = [r["keyword"] for r in keywords.select("keyword").collect()]  # at most 80
    vectors = assigned.select(
        "paper_id", "cluster_id", paper_vector(corpus, F.col("weights")).alias("vector"), at.alias("analyzed_at")
    )
    tables = {
        "topic_clusters": topic_clusters(corpus, assigned, at),
        "paper_analysis": vectors,
        "keyword_stats": keywords,
        "keyword_papers": keyword_links(corpus, chosen),
        "trend_stats": trend_stats(corpus),
        "analysis_meta": meta,
    }
    return Derived(**{name: _typed(name, df) for name, df in tables.items()})


def publish(derived: Derived, root: str, catalog_version: int) -> str:
    """Write every table under a new run folder, then append the pointer row that makes it current."""
    spark = derived.analysis_meta.sparkSession
    run_id = uuid.uuid4().hex
    for name, df in derived.tables().items():
        writer = df.write
        if name == "trend_stats":
            writer = df.repartition("venue").write.partitionBy("venue")
        writer.parquet(f"{root}/runs/{run_id}/{name}")
    pointer = spark.range(1).select(
        F.lit(run_id).alias("run_id"),
        F.lit(catalog_version).cast("bigint").alias("catalog_version"),
        F.current_timestamp().alias("published_at"),
    )
    pointer.coalesce(1).write.mode("append").parquet(f"{root}/published_runs")
    return run_id


def published(spark, root: str, run_id: str) -> Derived:
    """Read a published run back."""
    return Derived(**{n: spark.read.schema(s).parquet(f"{root}/runs/{run_id}/{n}") for n, s in SCHEMAS.items()})


def summary(derived: Derived, limit: int = 10) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Metadata row, top topics, top keywords."""
    return (
        derived.analysis_meta,
        top_topics(derived.topic_clusters, limit),
        derived.keyword_stats.orderBy("rank").limit(limit),
    )
