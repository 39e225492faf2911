"""Topic clusters of the weighted corpus."""

from __future__ import annotations

import math
from multiprocessing.pool import ThreadPool

from pyspark import inheritable_thread_target
from pyspark.ml.clustering import KMeans, KMeansModel
from pyspark.sql import Column, DataFrame, Window, functions as F

from citewell.functions.text import cluster_label
from citewell.functions.tokens import one_per_row
from citewell.operators.terms import WeightedCorpus, entries

# First seed, number of starts, most iterations per start, terms that name a cluster.
FIRST_SEED = 42
STARTS = 10
MAX_ITERATIONS = 300
LABEL_TERMS = 5


def cluster_count(paper_count: int) -> int:
    """One cluster for at most one paper, else about the square root, within 2..10."""
    return 1 if paper_count <= 1 else min(10, max(2, round(math.sqrt(paper_count))))


def best_start(
    vectors: DataFrame, k: int, starts: int = STARTS, seed: int = FIRST_SEED, max_iterations: int = MAX_ITERATIONS,
    features: str = "weights", parallelism: int = 2,
) -> KMeansModel:
    """K-means from several seeds; the lowest cost wins, the lower seed on a tie.

    The vectors are not persisted here: each start then keeps them as vectors with their norms while it
    runs, where a persisted table would be decoded again in every iteration.  Two run side by side, so that
    the short driver steps of one do not idle executors and no more than two copies are held.
    """
    data = vectors.select(features)

    def fit(n: int) -> KMeansModel:
        return KMeans(k=k, seed=n, maxIter=max_iterations, featuresCol=features, predictionCol="cluster_id").fit(data)

    pool = ThreadPool(min(parallelism, starts))
    models = pool.map(inheritable_thread_target(vectors.sparkSession)(fit), range(seed, seed + starts))
    pool.close()
    # Starts that reach one optimum differ in the last digits only; the first of them wins.
    return min(models, key=lambda m: float(f"{m.summary.trainingCost:.8e}"))


def assign(corpus: WeightedCorpus, starts: int = STARTS) -> DataFrame:
    """The corpus vectors with a ``cluster_id``."""
    k = cluster_count(corpus.paper_count)
    if k == 1 or not corpus.terms:
        return corpus.vectors.withColumn("cluster_id", F.lit(0))
    return best_start(corpus.vectors, k, starts).transform(corpus.vectors)


def topic_clusters(corpus: WeightedCorpus, assigned: DataFrame, run_at: Column) -> DataFrame:
    """One row per cluster: label, size, score and heaviest terms of its mean vector."""
    sizes = assigned.groupBy("cluster_id").agg(F.count("*").alias("paper_count"))
    sums = (
        one_per_row(assigned, entries(F.col("weights")), "e", "cluster_id")
        .groupBy("cluster_id", F.col("e.indices").alias("idx"))
        .agg(F.sum("e.values").alias("weight"))
    )
    # At most ten clusters times the vocabulary from here on.
    heaviest = Window.partitionBy("cluster_id").orderBy(F.desc("weight"), F.asc("idx"))
    named = (
        sums.where("weight > 0")
        .withColumn("n", F.row_number().over(heaviest))
        .where(F.col("n") <= LABEL_TERMS)
        .groupBy("cluster_id")
        .agg(F.sort_array(F.collect_list(F.struct("n", corpus.term(F.col("idx")).alias("term")))).alias("top"))
        .select("cluster_id", F.col("top.term").alias("terms"))
    )
    scores = sums.groupBy("cluster_id").agg(F.sum("weight").alias("total"))
    terms = F.coalesce("terms", F.array().cast("array<string>"))
    joined = sizes.join(scores, "cluster_id", "left").join(named, "cluster_id", "left")
    return joined.select(
        "cluster_id",
        cluster_label(terms, F.col("cluster_id")).alias("label"),
        "paper_count",
        (F.coalesce("total", F.lit(0.0)) / F.col("paper_count")).alias("score"),
        terms.alias("terms"),
        run_at.alias("run_at"),
    )


def top_topics(clusters: DataFrame, limit: int = 10) -> DataFrame:
    return clusters.orderBy(F.desc("paper_count"), F.desc("score"), "cluster_id").limit(limit)
