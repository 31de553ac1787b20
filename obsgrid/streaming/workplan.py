"""Work units, resume decisions and backlog as relations."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from obsgrid.functions.columns import count_if, one_row, window_days, work_id
from obsgrid.functions.ordinals import batch_of, with_ordinal
from obsgrid.operators.ranking import keep_last
from obsgrid.schema import MANIFEST_SCHEMA
from obsgrid.session import exists

# Places per request and days per window.
BATCH_SIZE = 20
WINDOW_DAYS = 14

#: Ranges of ids that places are numbered in, and the accuracy of their edges.
ID_BUCKETS = 512
ID_ACCURACY = 100_000


def number_places(places: DataFrame, batch_size: int = BATCH_SIZE) -> DataFrame:
    """Catalogue rows with ordinal and batch number, in id order.

    Ids are cut at ``ID_BUCKETS`` approximate quantiles, so that each range holds about as many
    places, however the ids cluster.
    """
    key = F.col("location_id")
    cuts = [i / ID_BUCKETS for i in range(1, ID_BUCKETS)]
    edges = places.agg(
        F.array_sort(F.array_distinct(F.percentile_approx(key, cuts, ID_ACCURACY))).alias("edges")
    )
    bucket = F.size(F.filter("_cut.edges", lambda e: e < key))
    ranged = places.withColumn("_cut", one_row(edges, "edges"))
    numbered = with_ordinal(ranged, bucket, [key]).drop("_cut")
    return numbered.withColumn("batch_number", batch_of(F.col("ordinal"), batch_size))


def windows(start: Column, end: Column, days: int = WINDOW_DAYS) -> Column:
    """Consecutive inclusive windows over a span; the last one is cut at its end."""
    step = F.make_interval(days=F.lit(days))
    return F.transform(
        F.sequence(start, end, step),
        lambda s: F.struct(
            s.cast("date").alias("start_date"),
            F.least(F.date_add(s.cast("date"), days - 1), end).alias("end_date"),
        ),
    )


def work_plan(
    numbered: DataFrame,
    start: date | Column,
    end: date | Column,
    days: int = WINDOW_DAYS,
) -> DataFrame:
    """One row per batch and window. Windows unfold inside each batch row, without a join."""
    start = start if isinstance(start, Column) else F.lit(start)
    end = end if isinstance(end, Column) else F.lit(end)
    batches = numbered.groupBy("batch_number").agg(F.count(F.lit(1)).alias("locations"))
    spans = batches.withColumns({"_start": start, "_end": end})
    plan = spans.select(
        "batch_number", "locations", F.inline(windows(F.col("_start"), F.col("_end"), days))
    )
    return plan.withColumn(
        "work_id", work_id(F.col("batch_number"), F.col("start_date"), F.col("end_date"))
    ).withColumn("days", window_days(F.col("start_date"), F.col("end_date")))


def record_units(results: DataFrame, path: str) -> None:
    """Append outcomes (work_id, status, error) of finished units to the manifest."""
    stamped = results.withColumn("finished_at", F.current_timestamp())
    stamped.select(*MANIFEST_SCHEMA.fieldNames()).write.mode("append").parquet(path)


def read_manifest(spark: SparkSession, path: str) -> DataFrame:
    """The latest record of every unit; no manifest yet reads as an empty one."""
    if not exists(spark, path):
        return spark.createDataFrame([], MANIFEST_SCHEMA)
    records = spark.read.schema(MANIFEST_SCHEMA).parquet(path)
    return keep_last(records, ["work_id"], ["finished_at", "status"])


def pending_units(plan: DataFrame, manifest: DataFrame) -> DataFrame:
    """Planned units that have not succeeded yet."""
    done = manifest.where(F.col("status") == "success").select("work_id")
    return plan.join(done, "work_id", "left_anti")


def manifest_summary(manifest: DataFrame) -> DataFrame:
    """Units in total, succeeded and failed."""
    return manifest.agg(
        F.count(F.lit(1)).alias("total"),
        count_if(F.col("status") == "success").alias("success"),
        count_if(F.col("status") == "failed").alias("failed"),
    )


def resume_actions(plan: DataFrame, manifest: DataFrame, files: DataFrame) -> DataFrame:
    """What to do with every planned unit.

    Done with its file: skip. Done but the file is gone: fetch again. A file without a
    success record: adopt it if it passed validation, else replace it. Neither: fetch.
    ``files`` has work_id and valid.
    """
    done = manifest.where(F.col("status") == "success").select(
        "work_id", F.lit(True).alias("done")
    )
    present = files.select("work_id", "valid", F.lit(True).alias("present"))
    done_flag = F.coalesce("done", F.lit(False))
    present_flag = F.coalesce("present", F.lit(False))
    action = (
        F.when(done_flag & present_flag, "skip")
        .when(done_flag, "refetch")
        .when(present_flag & F.col("valid"), "adopt")
        .when(present_flag, "replace")
        .otherwise("fetch")
    )
    return (
        plan.select("work_id")
        .join(done, "work_id", "left")
        .join(present, "work_id", "left")
        .select("work_id", action.alias("action"))
    )


def backlog(files: DataFrame, manifest: DataFrame) -> DataFrame:
    """Files found, files converted, and files waiting."""
    done = manifest.where(F.col("status") == "success").select(
        "work_id", F.lit(True).alias("done")
    )
    return (
        files.select("work_id")
        .join(done, "work_id", "left")
        .agg(
            F.count(F.lit(1)).alias("files"),
            count_if(F.col("done")).alias("converted"),
            count_if(F.col("done").isNull()).alias("pending"),
        )
    )
