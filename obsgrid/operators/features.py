"""Per-place climate features and the five-measure profile."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from obsgrid.schema import IDENTITY, PROFILE_MEASURES

MONTHS = range(1, 13)
WET_DAY_MM = 1.0

FEATURES = (
    "mean_temperature",
    "temperature_std",
    "mean_diurnal_range",
    "temperature_p10",
    "temperature_p90",
    "temperature_p90_p10_range",
    "temperature_seasonality",
    "annual_precipitation",
    "precipitation_std",
    "wet_day_frequency",
    "maximum_daily_precipitation",
    "precipitation_seasonality",
    "mean_humidity",
    "humidity_std",
    "mean_wind",
    "wind_std",
)


def _by_month(aggregate: str, column: str) -> Column:
    """Twelve conditional aggregates as an array; months without data are NULL."""
    months = [f"{aggregate}(CASE WHEN month(date) = {m} THEN {column} END)" for m in MONTHS]
    return F.expr(f"array({', '.join(months)})")


def _spread(values: Column) -> Column:
    return F.array_max(values) - F.array_min(values)


def climate_features(
    daily: DataFrame,
    keys: Sequence[str] = IDENTITY,
    wet_day: float = WET_DAY_MM,
    years: int | None = None,
) -> DataFrame:
    """Sixteen features per place in one grouped pass.

    The seasonal spreads are month-conditional aggregates of the same group, so there is one
    shuffle and no join. Quantiles are exact; a group is one place's calendar of days. Yearly
    figures divide by ``years``, or by the years the place was observed.
    """
    rain = F.col("precipitation_sum")
    divisor = F.lit(years) if years else F.size(F.collect_set(F.year("date")))
    base = daily.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("observation_days"),
        F.avg("temperature_mean").alias("mean_temperature"),
        F.stddev_samp("temperature_mean").alias("temperature_std"),
        F.avg(F.col("temperature_max") - F.col("temperature_min")).alias("mean_diurnal_range"),
        F.percentile("temperature_mean", F.array(F.lit(0.1), F.lit(0.9))).alias("_q"),
        _by_month("avg", "temperature_mean").alias("_month_temperature"),
        F.sum(rain).alias("_rain"),
        divisor.alias("_years"),
        F.stddev_samp(rain).alias("precipitation_std"),
        F.avg(F.when(rain > wet_day, 1.0).otherwise(0.0)).alias("wet_day_frequency"),
        F.max(rain).alias("maximum_daily_precipitation"),
        _by_month("sum", "precipitation_sum").alias("_month_rain"),
        F.avg("relative_humidity_mean").alias("mean_humidity"),
        F.stddev_samp("relative_humidity_mean").alias("humidity_std"),
        F.avg("wind_speed_mean").alias("mean_wind"),
        F.stddev_samp("wind_speed_mean").alias("wind_std"),
    )
    complete = base.withColumns(
        {
            "temperature_p10": F.col("_q")[0],
            "temperature_p90": F.col("_q")[1],
            "temperature_p90_p10_range": F.col("_q")[1] - F.col("_q")[0],
            "temperature_seasonality": _spread(F.col("_month_temperature")),
            "annual_precipitation": F.col("_rain") / F.col("_years"),
            "precipitation_seasonality": _spread(F.col("_month_rain")) / F.col("_years"),
        }
    )
    return complete.select(*keys, "observation_days", *FEATURES)


def seasonality(daily: DataFrame, keys: Sequence[str] = ("location_id",)) -> DataFrame:
    """Warmest minus coldest, and wettest minus driest, calendar month per place.

    Two levels: the first shrinks days to at most twelve rows per place.
    """
    months = daily.groupBy(*keys, F.month("date").alias("month")).agg(
        F.avg("temperature_mean").alias("temperature"),
        F.sum("precipitation_sum").alias("rain"),
        F.collect_set(F.year("date")).alias("years"),
    )
    years = F.size(F.array_distinct(F.flatten(F.collect_list("years"))))
    return months.groupBy(*keys).agg(
        (F.max("temperature") - F.min("temperature")).alias("temperature_seasonality"),
        ((F.max("rain") - F.min("rain")) / years).alias("precipitation_seasonality"),
    )


def city_profile(daily: DataFrame, keys: Sequence[str] = IDENTITY) -> DataFrame:
    """Mean of the five profile measures and the number of days, per place."""
    return daily.groupBy(*keys).agg(
        *[F.avg(m).alias(m) for m in PROFILE_MEASURES],
        F.count(F.lit(1)).alias("daily_observation_count"),
    )
