"""Dense global row numbers without a one-task window over rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from citewell.session import staged


def with_row_index(df: DataFrame, order_by: Sequence[Column | str], name: str = "row_index", start: int = 1) -> DataFrame:
    """Number rows from ``start`` in a total order.

    Rows are range-partitioned, sorted and fixed as a stage table that holds each row's
    partition and place.  The rows of each partition are counted, a running sum over the
    counts gives where each partition starts, and the starts are joined on the partition number:
    one row for each partition, so they are broadcast.  ``order_by`` must end in a unique
    column, so that no run of equal keys lands in one partition.
    """
    ordered = df.repartitionByRange(*order_by).sortWithinPartitions(*order_by)
    within = F.expr("monotonically_increasing_id() - shiftleft(cast(spark_partition_id() as bigint), 33)")
    fixed = staged(ordered.withColumn("_part", F.spark_partition_id()).withColumn("_at", within), "rows")
    counts = fixed.groupBy("_part").agg(F.count("*").alias("_rows"))
    before = F.sum("_rows").over(Window.orderBy("_part")) - F.col("_rows")
    starts = counts.select("_part", (before + F.lit(start)).alias("_start"))
    numbered = fixed.join(F.broadcast(starts), "_part")
    return numbered.select(*df.columns, (F.col("_start") + F.col("_at")).alias(name))
