"""Small helpers that several operators share."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from obsgrid.session import scratch_path

#: A word of the mixing and fingerprint contracts: a run of anything but ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def written(df: DataFrame, label: str) -> DataFrame:
    """The rows as a table in the shared folder: cuts lineage and survives a lost executor."""
    spark = df.sparkSession
    path = scratch_path(spark, label)
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._written_path = path
    return out


def dropped(df: DataFrame) -> None:
    """Remove a table that ``written`` made and nobody reads any more."""
    path = getattr(df, "_written_path", None)
    if path:
        spark = df.sparkSession
        target = spark._jvm.org.apache.hadoop.fs.Path(path)
        target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


@contextmanager
def batches_of(spark: SparkSession, rows: int) -> Iterator[None]:
    """Python tasks that run inside get so many rows at a time."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, rows)
    try:
        yield
    finally:
        spark.conf.set(name, before)


def text_or_empty(text: str = "text") -> Column:
    return F.coalesce(F.col(text).cast("string"), F.lit(""))


def fold_remainder(doc_id: str, divisor: int) -> Column:
    """crc32 of the id written as text, modulo the number of folds."""
    return F.crc32(F.col(doc_id).cast("string")) % divisor
