"""Incremental import: each micro-batch is merged into a library once."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming.query import StreamingQuery

from citewell.plans.library import Library
from citewell.schemas import PAPER_IN


def paper_stream(spark: SparkSession, path: str, files_per_batch: int | None = None) -> DataFrame:
    """Import rows from JSON-lines files as they arrive in a folder."""
    reader = spark.readStream.schema(PAPER_IN)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.json(path)


def content_of(batch: DataFrame) -> str:
    """A name of a batch's rows, whatever their order."""
    row = F.xxhash64(F.to_json(F.struct(*batch.columns), {"ignoreNullFields": "false"}))
    named = batch.select(row.alias("row"))
    n, total = named.agg(F.count("*"), F.sum(F.col("row").cast("decimal(38,0)"))).first()
    return f"{n}-{total or 0}"


def start_import(
    stream: DataFrame, library: Library, checkpoint: str, source_query: str, refresh_every: int = 1
) -> StreamingQuery:
    """Merge every micro-batch, and refresh the derived tables on each ``refresh_every``-th.

    The batch number and a hash of the batch's rows are stored with the catalog version they
    made: when Spark replays a batch after a failure, or a lost checkpoint replays all, the merge
    is skipped and only the refresh is repeated.  Another stream of the same ``source_query``, or a
    fresh checkpoint that cuts the files into other batches, brings other rows and is merged.
    """

    def merge(batch: DataFrame, number: int) -> None:
        content = content_of(batch)
        arrived = batch.withColumn("_seq", F.coalesce("_seq", F.monotonically_increasing_id())).persist()
        try:
            library.upsert(arrived, source_query, batch_id=f"{source_query}#{number}#{content}", refresh=False)
        finally:
            arrived.unpersist()
        if refresh_every and (number + 1) % refresh_every == 0 and library.is_stale():
            library.refresh()

    return (
        stream.writeStream.foreachBatch(merge)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
