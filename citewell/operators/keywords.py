"""Keyword ranking, keyword-to-paper links, per-paper vectors, drill-down."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from citewell.functions.text import casefold, strip
from citewell.functions.tokens import one_per_row
from citewell.operators.search import MOST_ROWS, all_papers, newest_first, page_size
from citewell.operators.terms import WeightedCorpus, entries, looked_up

# Ranked keywords kept, and terms kept per paper vector.
KEYWORDS_KEPT = 80
VECTOR_TERMS_KEPT = 60

# Decimals at which total weights count as equal in the ranking; below this only
# the order of floating-point additions shows.
_TIE_DECIMALS = 9


def term_stats(corpus: WeightedCorpus) -> DataFrame:
    """``(keyword, paper_count, total)``: one partial-aggregated row per term."""
    stats = corpus.long().groupBy("idx").agg(F.count("*").alias("paper_count"), F.sum("weight").alias("total"))
    return stats.select(corpus.term(F.col("idx")).alias("keyword"), "paper_count", "total")


def rank_keywords(stats: DataFrame, run_at: Column, kept: int = KEYWORDS_KEPT) -> DataFrame:
    """Top keywords by paper count, then total weight, then name."""
    order = [F.desc("paper_count"), F.desc(F.round("total", _TIE_DECIMALS)), F.asc("keyword")]
    top = stats.orderBy(*order).limit(kept)
    return top.select(
        "keyword",
        "paper_count",
        F.round("total", 6).alias("weight"),
        F.row_number().over(Window.orderBy(*order)).alias("rank"),
        run_at.alias("run_at"),
    )


def keyword_links(corpus: WeightedCorpus, keywords: list[str]) -> DataFrame:
    """``(keyword, paper_id)`` for the ranked keywords; filtered before rows are exploded."""
    position = {term: i for i, term in enumerate(corpus.terms)}
    wanted = [position[k] for k in keywords]
    indices = F.filter(F.unwrap_udt(F.col("weights"))["indices"], lambda i: i.isin(wanted))
    linked = one_per_row(corpus.vectors, indices, "idx", "paper_id")
    return linked.select(corpus.term(F.col("idx")).alias("keyword"), "paper_id")


def paper_vector(corpus: WeightedCorpus, weights: Column, kept: int = VECTOR_TERMS_KEPT) -> Column:
    """Heaviest terms of one paper, rounded, as an ordered array; computed inside the row."""
    positive = F.filter(entries(weights), lambda e: e["values"] > 0)
    rounded = F.transform(
        positive, lambda e: F.struct((-F.round(e["values"], 6)).alias("minus"), e["indices"].alias("idx"))
    )
    return F.transform(
        F.slice(F.sort_array(rounded), 1, kept),
        lambda e: F.struct(looked_up(corpus.terms, e["idx"]).alias("term"), (-e["minus"]).alias("weight")),
    )


def papers_for_keyword(links: DataFrame, papers: DataFrame, keyword: str, asked: object = 50) -> DataFrame:
    """Newest papers linked to a keyword, as many as ``page_size`` makes of the asked number."""
    wanted = links.where(F.col("keyword") == strip(casefold(F.lit(keyword)))).select(F.col("paper_id").alias("id"))
    shown = all_papers(papers.join(wanted, "id", "left_semi").select(*papers.columns), MOST_ROWS)
    place = F.row_number().over(Window.orderBy(*newest_first()))  # over MOST_ROWS rows
    return shown.withColumn("_place", place).where(F.col("_place") <= page_size(F.lit(asked))).drop("_place")
