"""Observation-shaped views over the TPC-H-like tables.

No weather is shipped with the tables, so suppliers act as places and their shipments as
daily readings. Readings are kept on a binary grid (1/65536): sums of grid values are exact
in double precision, so every total and mean is the same whatever the task order.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from obsgrid.functions.joins import small_side
from obsgrid.schema import DAILY_SCHEMA, IDENTITY, MEASURE_NAMES

GRID = 65536.0
#: Lines that a task folds to places and days, whatever the size of the table.
TASK_LINES = 500_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _cents(name: str) -> Column:
    return F.floor(F.col(name) * 100.0 + 0.5)


def _on_grid(total: Column, divisor: Column) -> Column:
    return F.floor(total.cast("double") * GRID / divisor) / GRID


def catalogue(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Suppliers as places; region and nation act as admin area and country."""
    supplier = table(spark, sf_dir, "supplier")
    nation = table(spark, sf_dir, "nation")
    region = table(spark, sf_dir, "region")
    key = F.col("s_suppkey")
    places = (
        supplier.join(nation, F.col("s_nationkey") == F.col("n_nationkey"))
        .join(region, F.col("n_regionkey") == F.col("r_regionkey"))
    )
    return places.select(
        key.alias("location_id"),
        F.col("s_name").alias("city"),
        F.col("s_name").alias("city_ascii"),
        F.col("n_name").alias("country"),
        F.concat(F.lit("N"), F.col("n_nationkey").cast("string")).alias("iso2"),
        F.concat(F.lit("N"), F.lpad(F.col("n_nationkey").cast("string"), 2, "0")).alias("iso3"),
        F.col("r_name").alias("admin_name"),
        F.when(F.col("s_acctbal") > 8000, "primary")
        .when(F.col("s_acctbal") > 5000, "admin")
        .when(F.col("s_acctbal") > 2000, "minor")
        .alias("capital"),
        ((key * 37) % 181 - 90).cast("double").alias("latitude"),
        ((key * 53) % 361 - 180).cast("double").alias("longitude"),
        F.when(F.col("s_acctbal") > 0, F.floor(F.col("s_acctbal") * 1000).cast("double")).alias(
            "population"
        ),
    )


def readings(spark: SparkSession, sf_dir: str, start_date: Column | None = None) -> DataFrame:
    """One row per place and day, measures only.

    Shipments are folded to (place, day) before any other table is touched: the one shuffle
    carries numbers, never names. Few shipments share a place and a day, so they are sent as
    they are, to as many tasks as keep a task's groups bounded. ``start_date`` names the window
    of a ``date``; the rows have it then, and those of a place's window are in one task.
    """
    lines = table(spark, sf_dir, "lineitem")
    tasks = max(spark.sparkContext.defaultParallelism, -(-lines.count() // TASK_LINES))
    lines = lines.select(
        F.col("l_suppkey").alias("location_id"),
        F.col("l_shipdate").cast("date").alias("date"),
        _cents("l_extendedprice").alias("price"),
        F.col("l_quantity").alias("quantity"),
        _cents("l_discount").alias("discount"),
        _cents("l_tax").alias("tax"),
    )
    window = []
    if start_date is not None:
        lines, window = lines.withColumn("start_date", start_date), ["start_date"]
    days = (
        lines.repartition(tasks, "location_id", *(window or ["date"]))
        .groupBy("location_id", "date", *window)
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.sum("price").alias("price"),
            F.max("price").alias("price_max"),
            F.min("price").alias("price_min"),
            F.sum("quantity").alias("quantity"),
            F.sum("discount").alias("discount"),
            F.sum("tax").alias("tax"),
        )
    )
    n = F.col("n").cast("double")
    return days.select(
        "location_id",
        "date",
        *window,
        F.year("date").alias("year"),
        _on_grid(F.col("price"), n * 100000.0).alias("temperature_mean"),
        _on_grid(F.col("price_max"), F.lit(100000.0)).alias("temperature_max"),
        _on_grid(F.col("price_min"), F.lit(100000.0)).alias("temperature_min"),
        F.col("quantity").alias("precipitation_sum"),
        _on_grid(F.col("discount"), n).alias("relative_humidity_mean"),
        _on_grid(F.col("tax"), n).alias("wind_speed_mean"),
        _on_grid(F.col("price"), F.col("quantity") * 100.0).alias("surface_pressure_mean"),
    )


def daily_obs(spark: SparkSession, sf_dir: str, start_date: Column | None = None) -> DataFrame:
    """The daily observation table: readings with the columns of their place. Rows of a place's
    window are in one task if ``start_date`` names it."""
    places = places_side(spark, sf_dir).withColumnsRenamed(
        {"latitude": "source_latitude", "longitude": "source_longitude"}
    )
    return (
        readings(spark, sf_dir, start_date)
        .join(places.drop("population"), "location_id")
        .withColumns(
            {
                "model_latitude": F.col("source_latitude") + 0.125,
                "model_longitude": F.col("source_longitude") - 0.125,
                "timezone": F.concat(F.lit("Zone/"), "iso3"),
                "elevation": ((F.col("location_id") * 29) % 3000).cast("double"),
            }
        )
        .select(*DAILY_SCHEMA.fieldNames())
    )


def places_side(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The catalogue as a join side; the supplier table bounds its rows."""
    return small_side(catalogue(spark, sf_dir), table(spark, sf_dir, "supplier").count())


def with_identity(per_location: DataFrame, spark: SparkSession, sf_dir: str) -> DataFrame:
    """Names and codes for rows already folded to one per place: no name is ever shuffled
    with the observations."""
    places = places_side(spark, sf_dir).select(*IDENTITY)
    rest = [c for c in per_location.columns if c not in IDENTITY]
    return per_location.join(places, "location_id").select(*IDENTITY, *rest)


def given_clusters(df: DataFrame) -> DataFrame:
    """A fixed assignment, so that everything computed from an assignment can be checked."""
    return df.withColumn("cluster_id", (F.col("location_id") % 4).cast("int"))


CATALOGUE_SQL = """
catalogue AS (
  SELECT s_suppkey AS location_id, s_name AS city, s_name AS city_ascii, n_name AS country,
    'N' || CAST(n_nationkey AS VARCHAR) AS iso2,
    'N' || LPAD(CAST(n_nationkey AS VARCHAR), 2, '0') AS iso3,
    r_name AS admin_name,
    CASE WHEN s_acctbal > 8000 THEN 'primary' WHEN s_acctbal > 5000 THEN 'admin'
         WHEN s_acctbal > 2000 THEN 'minor' END AS capital,
    CAST((s_suppkey * 37) % 181 - 90 AS DOUBLE) AS latitude,
    CAST((s_suppkey * 53) % 361 - 180 AS DOUBLE) AS longitude,
    CASE WHEN s_acctbal > 0 THEN CAST(FLOOR(s_acctbal * 1000) AS DOUBLE) END AS population
  FROM supplier JOIN nation ON s_nationkey = n_nationkey
  JOIN region ON n_regionkey = r_regionkey)"""

READINGS_SQL = """
lines AS (
  SELECT l_suppkey AS location_id, CAST(l_shipdate AS DATE) AS date, l_quantity,
    CAST(FLOOR(l_extendedprice * 100.0::DOUBLE + 0.5::DOUBLE) AS BIGINT) AS price,
    CAST(FLOOR(l_discount * 100.0::DOUBLE + 0.5::DOUBLE) AS BIGINT) AS discount,
    CAST(FLOOR(l_tax * 100.0::DOUBLE + 0.5::DOUBLE) AS BIGINT) AS tax
  FROM lineitem),
days AS (
  SELECT location_id, date, CAST(COUNT(*) AS DOUBLE) AS n, SUM(l_quantity) AS quantity,
    CAST(SUM(price) AS DOUBLE) AS price, CAST(MAX(price) AS DOUBLE) AS price_max,
    CAST(MIN(price) AS DOUBLE) AS price_min, CAST(SUM(discount) AS DOUBLE) AS discount,
    CAST(SUM(tax) AS DOUBLE) AS tax
  FROM lines GROUP BY location_id, date),
readings AS (
  SELECT location_id, date, CAST(EXTRACT(YEAR FROM date) AS INTEGER) AS year,
    FLOOR(price * 65536.0::DOUBLE / (n * 100000.0::DOUBLE)) / 65536.0::DOUBLE AS temperature_mean,
    FLOOR(price_max * 65536.0::DOUBLE / 100000.0::DOUBLE) / 65536.0::DOUBLE AS temperature_max,
    FLOOR(price_min * 65536.0::DOUBLE / 100000.0::DOUBLE) / 65536.0::DOUBLE AS temperature_min,
    quantity AS precipitation_sum,
    FLOOR(discount * 65536.0::DOUBLE / n) / 65536.0::DOUBLE AS relative_humidity_mean,
    FLOOR(tax * 65536.0::DOUBLE / n) / 65536.0::DOUBLE AS wind_speed_mean,
    FLOOR(price * 65536.0::DOUBLE / (quantity * 100.0::DOUBLE)) / 65536.0::DOUBLE
      AS surface_pressure_mean
  FROM days)"""

DAILY_COLUMNS = DAILY_SCHEMA.fieldNames()

DAILY_SQL = f"""{CATALOGUE_SQL},{READINGS_SQL},
daily_obs AS (
  SELECT r.location_id, city, city_ascii, country, iso2, iso3, admin_name, capital,
    latitude AS source_latitude, longitude AS source_longitude,
    latitude + 0.125::DOUBLE AS model_latitude, longitude - 0.125::DOUBLE AS model_longitude,
    'Zone/' || iso3 AS timezone,
    CAST((r.location_id * 29) % 3000 AS DOUBLE) AS elevation,
    date, {', '.join(MEASURE_NAMES)}, year
  FROM readings r JOIN catalogue c ON r.location_id = c.location_id)"""
