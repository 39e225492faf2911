"""Vocabulary and TF-IDF weights of the corpus."""

from __future__ import annotations

import math
from collections.abc import Iterable, Sequence
from dataclasses import dataclass

from pyspark.ml.feature import CountVectorizerModel, ElementwiseProduct, Normalizer
from pyspark.ml.linalg import Vectors
from pyspark.sql import Column, DataFrame, functions as F

from citewell.functions.text import analysis_document
from citewell.functions.tokens import bigrams, known_words, ngrams, one_per_row, tokens
from citewell.functions.vocab import STOP_WORDS
from citewell.session import spread, staged

# Fixed value: vocabulary size.
VOCABULARY_SIZE = 4000

_CARRIED = ("venue", "year", "paper_type")


def paper_tokens(papers: DataFrame, stop_words: Iterable[str] = STOP_WORDS) -> DataFrame:
    """``(paper_id, tokens)`` and the columns trends need; no shuffle on large inputs."""
    document = analysis_document(F.col("title"), F.col("abstract"), F.col("keywords"))
    source = spread(papers.select("id", "title", "abstract", "keywords", *_CARRIED), "id")
    return source.select(F.col("id").alias("paper_id"), *_CARRIED, tokens(document, stop_words).alias("tokens"))


def tokenized(papers: DataFrame, stop_words: Iterable[str] = STOP_WORDS) -> DataFrame:
    """``paper_tokens`` as a stage table.

    The token pattern is the dearest step per byte, so it runs once; the passes over
    the corpus then read token columns, which compress well.
    """
    return staged(paper_tokens(papers, stop_words), "tokens")


def counted(terms: Column, corpus: DataFrame) -> DataFrame:
    """``(term, n)`` over all rows of an array column; partial counts before the shuffle."""
    return one_per_row(corpus, terms, "term").groupBy("term").agg(F.count("*").alias("n"))


def _largest(counts: DataFrame, limit: int) -> list[tuple[str, int]]:
    """The ``limit`` largest counts, ties by term.

    The limited rows are gathered by one more aggregate, so that the partial lists of
    many partitions meet in a task and only the final list reaches the driver.
    """
    top = counts.orderBy(F.desc("n"), "term").limit(limit)
    rows = top.agg(F.collect_list(F.struct("term", "n")).alias("rows")).first()["rows"]
    return sorted(((r["term"], r["n"]) for r in rows), key=_rank)


def _rank(entry: tuple[str, int]) -> tuple[int, str]:
    return -entry[1], entry[0]


def vocabulary(corpus: DataFrame, size: int = VOCABULARY_SIZE) -> list[tuple[str, int]]:
    """The ``size`` 1- and 2-grams with the highest corpus counts, ties by term.

    A pair cannot be more frequent than its rarer word.  So single words are counted
    first; once ``size`` of them are at hand, only pairs of words at least as frequent
    as the last one can still enter, and the rest are never shuffled.  (Where ties would
    make that list long, all pairs are counted.)  The driver holds ``3 * size`` rows.
    """
    words = _largest(counted(F.col("tokens"), corpus), 2 * size)
    keep = None
    if len(words) >= size:
        floor = words[size - 1][1]
        if len(words) < 2 * size or words[-1][1] < floor:
            keep = [term for term, n in words if n >= floor]
    if keep is not None:
        corpus = corpus.select(known_words("tokens", keep).alias("tokens"))
    pairs = _largest(counted(bigrams(F.col("tokens")), corpus), size)
    return sorted(words[:size] + pairs, key=_rank)[:size]


def looked_up(terms: Sequence[str], index: Column) -> Column:
    """Term at a zero-based index, from a constant array."""
    return F.element_at(F.split(F.lit("\t".join(terms)), "\t"), index + 1)


def count_vectors(corpus: DataFrame, terms: Sequence[str]) -> DataFrame:
    """Sparse term counts over the vocabulary; narrow, the vocabulary travels to the tasks."""
    model = CountVectorizerModel.from_vocabulary(list(terms), inputCol="grams", outputCol="tf")
    grams = corpus.select("paper_id", *_CARRIED, ngrams(F.col("tokens")).alias("grams"))
    return model.transform(grams).drop("grams")


def entries(vector: Column) -> Column:
    """Array of ``(indices, values)`` structs of a sparse vector."""
    raw = F.unwrap_udt(vector)
    return F.arrays_zip(raw["indices"].alias("indices"), raw["values"].alias("values"))


def document_frequency(counts: DataFrame) -> DataFrame:
    """``(idx, df)``: papers that hold each vocabulary term."""
    indices = F.unwrap_udt(F.col("tf"))["indices"]
    return one_per_row(counts, indices, "idx").groupBy("idx").agg(F.count("*").alias("df"))


@dataclass(frozen=True)
class WeightedCorpus:
    """Papers as unit-length TF-IDF vectors over a sorted vocabulary."""

    terms: list[str]
    vectors: DataFrame  # paper_id, venue, year, paper_type, weights
    paper_count: int

    def long(self) -> DataFrame:
        """``(paper_id, venue, year, paper_type, idx, weight)``, one row per positive weight."""
        exploded = one_per_row(self.vectors, entries(F.col("weights")), "e", "paper_id", *_CARRIED)
        return exploded.select(
            "paper_id", *_CARRIED, F.col("e.indices").alias("idx"), F.col("e.values").alias("weight")
        )

    def term(self, index: Column) -> Column:
        return looked_up(self.terms, index)


def weigh(papers: DataFrame, stop_words: Iterable[str] = STOP_WORDS, size: int = VOCABULARY_SIZE) -> WeightedCorpus:
    """Weigh the corpus: tf x (ln((1+n)/(1+df)) + 1), each paper scaled to length one.

    The staged tokens are read three times (words, pairs, counts).  The sparse counts are
    staged too; everything after reads them and never shuffles them.
    """
    corpus = tokenized(papers, stop_words)
    terms = sorted(term for term, _ in vocabulary(corpus, size))
    if not terms:
        empty = papers.sparkSession.createDataFrame([], "paper_id BIGINT, venue STRING, year INT, paper_type STRING")
        vectors = empty.withColumn("weights", F.lit(None))
        return WeightedCorpus([], vectors, papers.count())
    counts = staged(count_vectors(corpus, terms), "counts")
    paper_count = counts.count()
    frequency = {r["idx"]: r["df"] for r in document_frequency(counts).collect()}
    idf = [math.log((1 + paper_count) / (1 + frequency[i])) + 1 for i in range(len(terms))]
    scale = ElementwiseProduct(scalingVec=Vectors.dense(idf), inputCol="tf", outputCol="raw")
    unit = Normalizer(p=2.0, inputCol="raw", outputCol="weights")
    vectors = unit.transform(scale.transform(counts)).drop("tf", "raw")
    return WeightedCorpus(terms, vectors, paper_count)
