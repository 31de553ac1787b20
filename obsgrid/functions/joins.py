"""Joins that stay right whatever the size of the smaller side."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

BROADCAST_BYTES = 64 * 1024 * 1024
#: Bytes that a text, and that any other value, is counted with.
TEXT_BYTES, VALUE_BYTES = 40, 8


def row_bytes(schema: T.StructType) -> int:
    """About how much a row of the schema takes."""
    return sum(TEXT_BYTES if isinstance(f.dataType, T.StringType) else VALUE_BYTES for f in schema)


def small_side(df: DataFrame, rows: int | None = None, limit: int = BROADCAST_BYTES) -> DataFrame:
    """Mark a join side for broadcast if its rows take at most ``limit`` bytes.

    Row counts of Parquet tables come from their footers. Beyond the limit nothing is
    marked: the join shuffles both sides, and AQE splits the partitions of a hot key.
    Pass ``rows`` when the count of an underlying table already bounds the side.
    """
    found = df.count() if rows is None else rows
    return F.broadcast(df) if found * row_bytes(df.schema) <= limit else df
