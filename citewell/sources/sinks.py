"""Export sinks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from citewell.operators.rowindex import with_row_index

# Export order: newest first, then by title; id settles ties.
EXPORT_ORDER = (F.desc_nulls_last, "year"), (F.asc_nulls_first, "title"), (F.asc_nulls_first, "id")


def export_order() -> list:
    return [direction(name) for direction, name in EXPORT_ORDER]


def export_json(papers: DataFrame, path: str) -> None:
    """Whole catalog as JSON lines in export order (a range-partitioned sort)."""
    papers.orderBy(*export_order()).write.json(path)


def numbered_batches(papers: DataFrame, batch_size: int = 50) -> DataFrame:
    """Adds ``row_index`` in export order and ``batch_no`` = 0, 0, ..., 1, 1, ..."""
    if batch_size < 1:
        raise ValueError("batch size must be positive")
    indexed = with_row_index(papers, export_order())
    return indexed.withColumn("batch_no", F.floor((F.col("row_index") - 1) / batch_size))


def export_batches(papers: DataFrame, path: str, batch_size: int = 50, batches_per_folder: int = 1000) -> None:
    """JSON lines that carry their ``batch_no``, in folders of many batches each.

    One folder per batch would make a folder for every few rows.
    """
    numbered = numbered_batches(papers, batch_size).withColumn(
        "batch_group", F.expr(f"batch_no div {batches_per_folder}")
    )
    numbered.drop("row_index").write.partitionBy("batch_group").json(path)


def write_collection(
    papers: DataFrame, path: str, source: str, source_url: str, queries: Sequence[str], retrieved_at: str
) -> None:
    """Collected papers plus one provenance row (source, time, queries, count)."""
    papers.write.json(f"{path}/papers")
    provenance(papers.sparkSession.read.schema(papers.schema).json(f"{path}/papers"), source, source_url, queries,
               retrieved_at).coalesce(1).write.json(f"{path}/provenance")


def provenance(papers: DataFrame, source: str, source_url: str, queries: Sequence[str], retrieved_at: str) -> DataFrame:
    return papers.agg(F.count("*").alias("count")).select(
        F.lit(source).alias("source"),
        F.lit(source_url).alias("source_url"),
        F.lit(retrieved_at).cast("timestamp").alias("retrieved_at"),
        F.array(*[F.lit(q) for q in queries]).cast("array<string>").alias("queries"),
        "count",
    )
