"""Descriptive statistics over the daily table and over profile tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from obsgrid.functions.columns import count_if, one_row, to_long
from obsgrid.functions.labels import STATISTIC_LABELS
from obsgrid.functions.quantiles import exact_quantiles
from obsgrid.schema import MEASURE_NAMES, SUMMED

QUARTILES = {"q25": 0.25, "median": 0.5, "q75": 0.75}


def dataset_summary(daily: DataFrame) -> DataFrame:
    """Rows, distinct places, countries and years, and the date span.

    Days are first folded to one row per place and year; the distinct counts then run over
    that small table instead of every observation.
    """
    folded = daily.groupBy("location_id", "city", "country", "year").agg(
        F.count(F.lit(1)).alias("n"), F.min("date").alias("first"), F.max("date").alias("last")
    )
    return folded.agg(
        F.sum("n").alias("total_rows"),
        F.count_distinct("location_id").alias("locations"),
        F.count_distinct("city").alias("cities"),
        F.count_distinct("country").alias("countries"),
        F.count_distinct("year").alias("years"),
        F.min("first").alias("min_date"),
        F.max("last").alias("max_date"),
    )


def rows_per_city(daily: DataFrame) -> DataFrame:
    return daily.groupBy("city", "country").agg(
        F.count(F.lit(1)).alias("row_count"),
        F.min("date").alias("min_date"),
        F.max("date").alias("max_date"),
    )


def row_count_distribution(daily: DataFrame) -> DataFrame:
    """How many places have how many rows."""
    return rows_per_city(daily).groupBy("row_count").agg(F.count(F.lit(1)).alias("cities"))


def missing_values(daily: DataFrame, columns: Sequence[str]) -> DataFrame:
    """NULLs per column, all columns in one pass."""
    counted = daily.agg(*[count_if(F.col(c).isNull()).alias(c) for c in columns])
    return counted.unpivot([], list(columns), "column_name", "missing")


def date_bounds(daily: DataFrame) -> DataFrame:
    return daily.agg(F.min("date").alias("min_date"), F.max("date").alias("max_date"))


def column_statistics(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Count, mean, sample deviation, extremes, quartiles and range, one row per column.

    All columns share their passes over the table; memory stays bounded on any input.
    """
    stats = exact_quantiles(df, columns, QUARTILES)
    return stats.select(
        "variable",
        "count",
        "mean",
        "std",
        "minimum",
        "q25",
        "median",
        "q75",
        "maximum",
        (F.col("maximum") - F.col("minimum")).alias("range"),
    )


def variable_summary(daily: DataFrame, keys: Sequence[str], variable: str) -> DataFrame:
    """Count, mean, extremes and median of one measure per key; NULLs are left out.

    A group is one place, so ``percentile`` sees at most its calendar of days.
    """
    value = F.col(variable)
    return daily.groupBy(*keys).agg(
        F.count(value).alias("count"),
        F.avg(value).alias("mean"),
        F.min(value).alias("minimum"),
        F.max(value).alias("maximum"),
        F.percentile(value, F.lit(0.5)).alias("median"),
    )


def eda_summary(daily: DataFrame, keys: Sequence[str], variable: str) -> DataFrame:
    """The fuller summary: also deviation, quartiles and range."""
    value = F.col(variable)
    quartiles = F.percentile(value, F.array(F.lit(0.25), F.lit(0.5), F.lit(0.75)))
    return (
        daily.groupBy(*keys)
        .agg(
            F.count(value).alias("count"),
            F.avg(value).alias("mean"),
            F.stddev_samp(value).alias("std"),
            F.min(value).alias("minimum"),
            quartiles.alias("q"),
            F.max(value).alias("maximum"),
        )
        .select(
            *keys,
            "count",
            "mean",
            "std",
            "minimum",
            F.col("q")[0].alias("q1"),
            F.col("q")[1].alias("median"),
            F.col("q")[2].alias("q3"),
            "maximum",
            (F.col("maximum") - F.col("minimum")).alias("range"),
        )
    )


def eda_summary_long(summary: DataFrame, keys: Sequence[str], unit: str) -> DataFrame:
    """A summary as (statistic, value, unit) rows; the count is in days."""
    statistics = list(STATISTIC_LABELS)
    long = to_long(summary, keys, statistics, "statistic", "value")
    named = F.create_map(*[F.lit(x) for item in STATISTIC_LABELS.items() for x in item])
    return long.select(
        *keys,
        named[F.col("statistic")].alias("statistic"),
        "value",
        F.when(F.col("statistic") == "count", "days").otherwise(unit).alias("unit"),
    )


def _over_time(variable: str) -> Column:
    """Totals for accumulated measures, means for the rest; an all-NULL period totals zero."""
    if variable in SUMMED:
        return F.coalesce(F.sum(variable), F.lit(0.0)).alias(variable)
    return F.avg(variable).alias(variable)


def monthly_series(
    daily: DataFrame, keys: Sequence[str], variables: Sequence[str] = MEASURE_NAMES
) -> DataFrame:
    """One row per key and month, named by the month's first day."""
    month = F.trunc("date", "month").alias("month")
    return daily.groupBy(*keys, month).agg(*[_over_time(v) for v in variables])


def yearly_series(
    daily: DataFrame, keys: Sequence[str], variables: Sequence[str] = MEASURE_NAMES
) -> DataFrame:
    return daily.groupBy(*keys, F.year("date").alias("year")).agg(
        *[_over_time(v) for v in variables]
    )


def monthly_temperature(daily: DataFrame) -> DataFrame:
    """Mean of each temperature measure per calendar month, all places and years."""
    return daily.groupBy(F.month("date").alias("month")).agg(
        F.avg("temperature_mean").alias("avg_temperature"),
        F.avg("temperature_max").alias("avg_max_temperature"),
        F.avg("temperature_min").alias("avg_min_temperature"),
    )


def monthly_precipitation(daily: DataFrame) -> DataFrame:
    """Daily mean per calendar month, and the total of an average place-year's month."""
    folded = daily.groupBy("location_id", "year", F.month("date").alias("month")).agg(
        F.sum("precipitation_sum").alias("total"), F.count("precipitation_sum").alias("days")
    )
    spans = folded.agg(
        F.count_distinct("year").alias("years"), F.count_distinct("location_id").alias("places")
    )
    return (
        folded.groupBy("month")
        .agg(F.sum("total").alias("total"), F.sum("days").alias("days"))
        .withColumn("span", one_row(spans, "years", "places"))
        .select(
            "month",
            (F.col("total") / F.col("days")).alias("avg_daily_precipitation"),
            (F.col("total") / (F.col("span.years") * F.col("span.places"))).alias(
                "avg_monthly_precipitation"
            ),
        )
    )


def temperature_by_city(daily: DataFrame) -> DataFrame:
    return daily.groupBy("city", "country").agg(
        F.avg("temperature_mean").alias("avg_temperature"),
        F.min("temperature_min").alias("lowest_temperature"),
        F.max("temperature_max").alias("highest_temperature"),
    )


def precipitation_by_city(daily: DataFrame) -> DataFrame:
    """Yearly average over the place's own years, daily mean and wettest day.

    ``collect_set`` of years is bounded by the calendar and avoids the row expansion that a
    distinct count brings.
    """
    return daily.groupBy("city", "country").agg(
        (F.sum("precipitation_sum") / F.size(F.collect_set("year"))).alias("avg_yearly_precipitation"),
        F.avg("precipitation_sum").alias("avg_daily_precipitation"),
        F.max("precipitation_sum").alias("max_daily_precipitation"),
    )


def feature_ranges(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Extremes and range per column."""
    rows = F.array(
        *[
            F.struct(
                F.lit(c).alias("variable"),
                F.min(c).cast("double").alias("minimum"),
                F.max(c).cast("double").alias("maximum"),
                (F.max(c) - F.min(c)).cast("double").alias("range"),
            )
            for c in columns
        ]
    )
    return df.agg(rows.alias("rows")).select(F.inline("rows"))


def feature_skewness(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Bias-adjusted skewness; NULL below three values."""

    def adjusted(c: str) -> Column:
        n = F.count(c).cast("double")
        factor = F.sqrt(n * (n - 1)) / F.when(n > 2, n - 2)
        return (F.skewness(c) * factor).alias("skewness")

    rows = F.array(*[F.struct(F.lit(c).alias("variable"), adjusted(c)) for c in columns])
    return df.agg(rows.alias("rows")).select(F.inline("rows"))


def correlation_pairs(df: DataFrame, columns: Sequence[str], top: int | None = None) -> DataFrame:
    """Pearson correlation of every pair of columns.

    A row unfolds once per column, not per pair; an aggregate holds that column's correlations
    with all others, so each task sends one row per column. A pair skips the rows where either
    value is NULL.
    """
    last = len(columns) - 1
    names = F.array(*[F.lit(c) for c in columns])
    values = df.select(F.array(*[F.col(c).cast("double") for c in columns]).alias("v"))
    firsts = values.select("v", F.posexplode(F.slice("v", 1, last)).alias("i", "x"))
    found = firsts.groupBy("i").agg(
        F.array(
            *[
                F.struct(F.lit(j).alias("j"), F.corr("x", F.get("v", F.lit(j))).alias("correlation"))
                for j in range(1, last + 1)
            ]
        ).alias("pairs")
    )
    pairs = (
        found.select("i", F.inline("pairs"))
        .where(F.col("j") > F.col("i"))
        .select(
            F.get(names, F.col("i")).alias("variable_1"),
            F.get(names, F.col("j")).alias("variable_2"),
            "correlation",
            F.abs("correlation").alias("abs_correlation"),
        )
    )
    if top is None:
        return pairs
    order = [F.col("abs_correlation").desc_nulls_last(), "variable_1", "variable_2"]
    return pairs.orderBy(*order).limit(top)


def overview(places: DataFrame) -> DataFrame:
    """Headline counts of a selection; an empty one has zero counts and no mean."""
    return places.agg(
        F.count(F.lit(1)).alias("locations"),
        F.count_distinct("country").alias("countries"),
        F.count_distinct("cluster_id").alias("clusters"),
        F.avg("temperature_c").alias("mean_temperature"),
    )


def country_distribution(places: DataFrame) -> DataFrame:
    """How many countries have how many places."""
    per = places.groupBy("country").agg(F.count(F.lit(1)).alias("places"))
    return per.groupBy("places").agg(F.count(F.lit(1)).alias("countries"))


def rows_per_date(daily: DataFrame, expected: int | Column) -> DataFrame:
    """Rows per day against the number of places."""
    expected = expected if isinstance(expected, Column) else F.lit(expected)
    counted = daily.groupBy("date").agg(F.count(F.lit(1)).alias("rows"))
    return counted.withColumn("expected", expected.cast("long")).withColumn(
        "complete", F.col("rows") == F.col("expected")
    )


def averages(df: DataFrame, names: Mapping[str, str]) -> DataFrame:
    """Global means, keyed by output name."""
    return df.agg(*[F.avg(column).alias(name) for name, column in names.items()])
