"""The place catalogue: CSV reader, selection under a per-country cap, and its rules."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from obsgrid.functions.columns import city_key
from obsgrid.schema import CATALOGUE_SCHEMA
from obsgrid.sources.tables import require_columns

REQUIRED = ("city", "city_ascii", "country", "iso3", "latitude", "longitude", "location_id")


def read_catalogue(spark: SparkSession, path: str, expected: int | None = None) -> DataFrame:
    """Header CSV with quoted commas; names in the header are checked against the schema."""
    reader = (
        spark.read.option("header", True)
        .option("quote", '"')
        .option("escape", '"')
        .option("encoding", "UTF-8")
        .option("enforceSchema", False)
        .option("mode", "FAILFAST")
    )
    places = require_columns(
        reader.schema(CATALOGUE_SCHEMA).csv(path), CATALOGUE_SCHEMA.fieldNames()
    )
    if expected is not None:
        found = places.count()
        if found != expected:
            raise ValueError(f"expected {expected} places, found {found}")
    return places


def write_catalogue(df: DataFrame, path: str) -> None:
    (
        df.select(*CATALOGUE_SCHEMA.fieldNames())
        .write.mode("overwrite")
        .option("header", True)
        .option("escape", '"')
        .option("encoding", "UTF-8")
        .csv(path)
    )


def valid_places(candidates: DataFrame) -> DataFrame:
    """Rows with every required field and coordinates on the globe."""
    return candidates.dropna(subset=list(REQUIRED)).where(
        F.col("latitude").between(-90, 90) & F.col("longitude").between(-180, 180)
    )


def select_places(
    candidates: DataFrame,
    target: int = 100,
    countries: int = 80,
    per_country: int = 3,
    min_population: float = 100_000,
) -> DataFrame:
    """Choose ``target`` places: one from each of the largest ``countries`` countries, then the
    largest remaining places of those countries, never more than ``per_country`` each.

    Because the cap holds per country, filling greedily by population equals keeping each
    country's ranks 2..cap and taking the largest of them. Ties go to the smaller id. A whole
    row represents a country, even where some of its fields are NULL. Too few countries or
    places fail with the shortage named.
    """
    by_size = [F.col("population").desc_nulls_last(), F.col("location_id").asc()]
    named = valid_places(candidates).withColumn("city_key", city_key(F.col("iso3"), F.col("city_ascii")))
    same_city = Window.partitionBy("city_key").orderBy(*by_size)
    same_country = Window.partitionBy("iso3").orderBy(*by_size)
    ranked = (
        named.withColumn("_copy", F.row_number().over(same_city))
        .where(F.col("_copy") == 1)
        .where(F.col("population") >= min_population)
        .withColumn("_rank", F.row_number().over(same_country))
        .where(F.col("_rank") <= per_country)
        .drop("_copy", "city_key")
    )
    leaders = ranked.where(F.col("_rank") == 1).orderBy(*by_size).limit(countries)
    extras = (
        ranked.where(F.col("_rank") > 1)
        .join(leaders.select("iso3"), "iso3", "left_semi")
        .orderBy(*by_size)
        .limit(target - countries)
    )
    chosen = leaders.unionByName(extras)
    counts = chosen.agg(
        F.count_if(F.col("_rank") == 1).alias("countries"), F.count(F.lit(1)).alias("places")
    ).select(F.struct("countries", "places").alias("c"))
    found = counts.scalar()
    enough = (found["countries"] == countries) & (found["places"] == target)
    shortage = F.raise_error(
        F.format_string(
            f"selection is short: %d of {countries} countries, %d of {target} places",
            found["countries"],
            found["places"],
        )
    )
    return (
        chosen.where(F.when(enough, F.lit(True)).otherwise(shortage.cast("boolean")))
        .drop("_rank")
        .orderBy(
            F.col("country").asc_nulls_last(),
            F.col("population").desc_nulls_last(),
            F.col("city_ascii").asc_nulls_last(),
            F.col("location_id").asc(),
        )
        .limit(target)
    )


def catalogue_rules(
    places: DataFrame, expected: int, countries: int, per_country: int
) -> DataFrame:
    """One row per rule: what was observed, what was expected, and whether it holds."""
    lat, lng = F.col("latitude"), F.col("longitude")
    per = places.groupBy("iso3").agg(F.count(F.lit(1)).alias("places"))
    cap = per.agg(
        F.max("places").alias("largest"),
        F.count("iso3").alias("countries"),
    )
    counts = places.agg(
        F.count(F.lit(1)).alias("rows"),
        (F.count(F.lit(1)) - F.count_distinct("location_id")).alias("duplicate_ids"),
        F.count_if(F.col("iso3").isNull()).alias("missing_codes"),
        F.count_if(lat.isNull() | lng.isNull()).alias("missing_coordinates"),
        F.count_if(~(lat.between(-90, 90) & lng.between(-180, 180))).alias("outside_globe"),
    )
    largest = cap.select(F.struct("largest", "countries").alias("cap")).scalar()
    facts = counts.withColumn("cap", largest)
    rules = [
        ("rows", F.col("rows"), expected, "equal"),
        ("duplicate_ids", F.col("duplicate_ids"), 0, "equal"),
        ("missing_codes", F.col("missing_codes"), 0, "equal"),
        ("missing_coordinates", F.col("missing_coordinates"), 0, "equal"),
        ("outside_globe", F.col("outside_globe"), 0, "equal"),
        ("largest_country", F.col("cap.largest"), per_country, "at most"),
        ("countries", F.col("cap.countries"), countries, "at least"),
    ]
    checks = {"equal": lambda a, b: a == b, "at most": lambda a, b: a <= b, "at least": lambda a, b: a >= b}
    rows = [
        F.struct(
            F.lit(rule).alias("rule"),
            observed.cast("long").alias("observed"),
            F.lit(limit).cast("long").alias("expected"),
            F.when(checks[test](observed, F.lit(limit)), "PASS").otherwise("FAIL").alias("status"),
        )
        for rule, observed, limit, test in rules
    ]
    return facts.select(F.inline(F.array(*rows)))
