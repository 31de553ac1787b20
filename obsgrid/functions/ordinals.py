"""Consecutive numbering without sorting a whole table in one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def with_ordinal(
    df: DataFrame, bucket: Column, order: Sequence[Column], name: str = "ordinal"
) -> DataFrame:
    """Number rows 1..n in ``order``; ``bucket`` must never decrease along that order.

    Rows are numbered inside their bucket, and each bucket starts after the rows of the
    buckets before it. Only the bucket sizes meet in one task.
    """
    keyed = df.withColumn("_bucket", bucket)
    sizes = keyed.groupBy("_bucket").agg(F.count(F.lit(1)).alias("_size"))
    earlier = Window.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select(
        "_bucket", F.coalesce(F.sum("_size").over(earlier), F.lit(0)).alias("_start")
    )
    inside = Window.partitionBy("_bucket").orderBy(*order)
    return (
        keyed.withColumn("_place", F.row_number().over(inside))
        .join(starts, "_bucket")
        .withColumn(name, F.col("_start") + F.col("_place"))
        .drop("_bucket", "_start", "_place")
    )


def batch_of(ordinal: Column, size: int) -> Column:
    """Batch number of a 1-based ordinal for batches of a fixed size."""
    return (F.floor((ordinal - 1) / F.lit(size)) + 1).cast("int")
