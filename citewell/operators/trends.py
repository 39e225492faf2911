"""Keyword trends by venue and year."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from citewell.functions.text import casefold, strip
from citewell.functions.vocab import CONFERENCES
from citewell.operators.terms import WeightedCorpus


def trend_stats(corpus: WeightedCorpus, venue: Column | None = None) -> DataFrame:
    """Papers per (keyword, venue, year) at the conferences, over the whole vocabulary.

    ``venue`` maps the stored venue before the comparison; by default it is upper-cased,
    so that only exact conference names count.
    """
    place = F.upper("venue") if venue is None else venue
    typed = F.coalesce("paper_type", F.lit("")) != "user-import"
    counted = (
        corpus.long()
        .where(place.isin(*CONFERENCES) & (F.col("year") != 0) & typed)
        .groupBy("idx", place.alias("venue"), "year")
        .agg(F.count("*").alias("paper_count"))
    )
    return counted.select(corpus.term(F.col("idx")).alias("keyword"), "venue", "year", "paper_count")


def select_trends(stats: DataFrame, keywords: Sequence[str] | DataFrame | None = None) -> DataFrame:
    """Trend rows of the chosen keywords (a list, or a table with ``keyword``), in report order."""
    if isinstance(keywords, DataFrame):
        chosen = keywords.select(strip(casefold(F.col("keyword"))).alias("keyword")).where("keyword <> ''")
        stats = stats.join(chosen.distinct(), "keyword", "left_semi")
    else:
        chosen = [k.casefold().strip() for k in keywords or [] if k.strip()]
        if chosen:
            stats = stats.where(F.col("keyword").isin(chosen))
    return stats.orderBy(F.asc_nulls_first("year"), "venue", "keyword").select(
        "keyword", "venue", "year", "paper_count"
    )


def trend_axes(records: DataFrame) -> DataFrame:
    """One row: the years present, ascending, and the conferences present, in fixed order."""
    present = records.agg(F.collect_set("year").alias("years"), F.collect_set("venue").alias("found"))
    order = F.array(*[F.lit(c) for c in CONFERENCES])
    return present.select(
        F.sort_array("years").alias("years"),
        F.filter(order, lambda c: F.array_contains(F.col("found"), c)).alias("venues"),
    )
