"""Collection grid: every venue with every year."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F

from citewell.functions.vocab import CONFERENCES

# Years collected by default.
YEARS = (2022, 2023, 2024, 2025)


def grid_queries(spark: SparkSession, venues: Sequence[str] = CONFERENCES, years: Sequence[int] = YEARS) -> DataFrame:
    """``(venue, year, query)`` cells, written out from the two given lists."""
    cells = [(v, y, f"venue:{v} year:{y}") for v in venues for y in years]
    return spark.createDataFrame(cells, "venue STRING, year INT, query STRING")


def grid_coverage(papers: DataFrame, venues: Sequence[str] = CONFERENCES, years: Sequence[int] = YEARS) -> DataFrame:
    """Papers per cell, zero where there are none.

    A venue text that names several conferences counts in each of their cells.
    """
    upper = F.upper("venue")
    named = F.filter(F.array(*[F.lit(v) for v in venues]), lambda v: F.contains(upper, v))
    counted = (
        papers.where(F.col("year").isin(*years))
        .select(F.explode(named).alias("venue"), "year")
        .groupBy("venue", "year")
        .agg(F.count("*").alias("n"))
    )
    cells = grid_queries(papers.sparkSession, venues, years).drop("query")
    return cells.join(counted, ["venue", "year"], "left").select(
        "venue", "year", F.coalesce("n", F.lit(0)).alias("paper_count")
    )


def cell_batches(records: DataFrame, venues: Sequence[str] = CONFERENCES, years: Sequence[int] = YEARS) -> DataFrame:
    """Records of each cell as one import batch, cell after cell.

    A record joins every cell whose venue its text names; ``source_query`` tells the cell.
    """
    numbered = F.array(*[F.struct(F.lit(v).alias("name"), F.lit(i).alias("no")) for i, v in enumerate(venues)])
    named = F.filter(numbered, lambda v: F.contains(F.upper("venue"), v["name"]))
    cells = records.where(F.col("year").isin(*years)).select("*", F.explode(named).alias("_cell"))
    cell_no = F.col("_cell.no") * len(years) + F.array_position(F.array(*[F.lit(y) for y in years]), F.col("year"))
    return (
        cells.withColumn("source_query", F.concat_ws(":", F.col("_cell.name"), F.col("year"), F.lit("openalex-crossref")))
        .withColumn("_seq", F.struct(cell_no.cast("int").alias("cell"), F.col("_seq").alias("seq")))
        .drop("_cell")
    )
