"""Data model: column schemas and the measure registry."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

KEY = ("location_id", "date")


@dataclass(frozen=True)
class Measure:
    """One daily measure: table column, payload variable, unit and rule over time."""

    name: str
    variable: str
    unit: str
    label: str
    rule: str = "mean"


# The daily measures, their payload variables, units and labels.
MEASURES = (
    Measure("temperature_mean", "temperature_2m_mean", "°C", "Temperature — Mean"),
    Measure("temperature_max", "temperature_2m_max", "°C", "Temperature — Maximum"),
    Measure("temperature_min", "temperature_2m_min", "°C", "Temperature — Minimum"),
    Measure("precipitation_sum", "precipitation_sum", "mm", "Rainfall / Precipitation", "sum"),
    Measure("relative_humidity_mean", "relative_humidity_2m_mean", "%", "Relative Humidity"),
    Measure("wind_speed_mean", "wind_speed_10m_mean", "km/h", "Wind Speed"),
    Measure("surface_pressure_mean", "surface_pressure_mean", "hPa", "Surface Pressure"),
)

MEASURE_NAMES = tuple(m.name for m in MEASURES)
SUMMED = frozenset(m.name for m in MEASURES if m.rule == "sum")

# The five measures that describe a place's profile, with their serving names.
PROFILE_MEASURES = (
    "temperature_mean",
    "precipitation_sum",
    "relative_humidity_mean",
    "wind_speed_mean",
    "surface_pressure_mean",
)
SERVING_NAMES = {
    "temperature_mean": "temperature_c",
    "precipitation_sum": "rainfall_mm_per_day",
    "relative_humidity_mean": "humidity_percent",
    "wind_speed_mean": "wind_speed_kmh",
    "surface_pressure_mean": "pressure_hpa",
}
SERVING_MEASURES = tuple(SERVING_NAMES[m] for m in PROFILE_MEASURES)

IDENTITY = ("location_id", "city", "city_ascii", "country", "iso2", "iso3")

CATALOGUE_SCHEMA = T.StructType(
    [
        T.StructField("location_id", T.LongType()),
        T.StructField("city", T.StringType()),
        T.StructField("city_ascii", T.StringType()),
        T.StructField("country", T.StringType()),
        T.StructField("iso2", T.StringType()),
        T.StructField("iso3", T.StringType()),
        T.StructField("admin_name", T.StringType()),
        T.StructField("capital", T.StringType()),
        T.StructField("latitude", T.DoubleType()),
        T.StructField("longitude", T.DoubleType()),
        T.StructField("population", T.DoubleType()),
    ]
)

DAILY_SCHEMA = T.StructType(
    [
        T.StructField("location_id", T.LongType()),
        T.StructField("city", T.StringType()),
        T.StructField("city_ascii", T.StringType()),
        T.StructField("country", T.StringType()),
        T.StructField("iso2", T.StringType()),
        T.StructField("iso3", T.StringType()),
        T.StructField("admin_name", T.StringType()),
        T.StructField("capital", T.StringType()),
        T.StructField("source_latitude", T.DoubleType()),
        T.StructField("source_longitude", T.DoubleType()),
        T.StructField("model_latitude", T.DoubleType()),
        T.StructField("model_longitude", T.DoubleType()),
        T.StructField("timezone", T.StringType()),
        T.StructField("elevation", T.DoubleType()),
        T.StructField("date", T.DateType()),
    ]
    + [T.StructField(m, T.DoubleType()) for m in MEASURE_NAMES]
    + [T.StructField("year", T.IntegerType())]
)

PAYLOAD_LOCATION = T.StructType(
    [
        T.StructField("latitude", T.DoubleType()),
        T.StructField("longitude", T.DoubleType()),
        T.StructField("timezone", T.StringType()),
        T.StructField("elevation", T.DoubleType()),
        T.StructField(
            "daily",
            T.StructType(
                [T.StructField("time", T.ArrayType(T.StringType()))]
                + [T.StructField(m.variable, T.ArrayType(T.DoubleType())) for m in MEASURES]
            ),
        ),
    ]
)
PAYLOAD_SCHEMA = T.ArrayType(PAYLOAD_LOCATION)

ENVELOPE_SCHEMA = T.StructType(
    [
        T.StructField("experiment", T.StringType()),
        T.StructField("model", T.StringType()),
        T.StructField("batch_number", T.IntegerType()),
        T.StructField("start_date", T.StringType()),
        T.StructField("end_date", T.StringType()),
        T.StructField("location_ids", T.ArrayType(T.LongType())),
        T.StructField("locations", PAYLOAD_SCHEMA),
    ]
)

CURRENT_SCHEMA = T.StructType(
    [
        T.StructField("timezone", T.StringType()),
        T.StructField(
            "current",
            T.StructType(
                [
                    T.StructField("time", T.StringType()),
                    T.StructField("temperature_2m", T.DoubleType()),
                    T.StructField("relative_humidity_2m", T.DoubleType()),
                    T.StructField("precipitation", T.DoubleType()),
                    T.StructField("wind_speed_10m", T.DoubleType()),
                    T.StructField("surface_pressure", T.DoubleType()),
                    T.StructField("weather_code", T.IntegerType()),
                    T.StructField("is_day", T.IntegerType()),
                ]
            ),
        ),
    ]
)

GEOCODING_SCHEMA = T.StructType(
    [
        T.StructField(
            "results",
            T.ArrayType(
                T.StructType(
                    [
                        T.StructField("name", T.StringType()),
                        T.StructField("country", T.StringType()),
                        T.StructField("country_code", T.StringType()),
                        T.StructField("admin1", T.StringType()),
                        T.StructField("latitude", T.DoubleType()),
                        T.StructField("longitude", T.DoubleType()),
                        T.StructField("timezone", T.StringType()),
                    ]
                )
            ),
        )
    ]
)

MANIFEST_SCHEMA = T.StructType(
    [
        T.StructField("work_id", T.StringType()),
        T.StructField("status", T.StringType()),
        T.StructField("finished_at", T.TimestampType()),
        T.StructField("error", T.StringType()),
    ]
)

STATE_SCHEMA = T.StructType(
    [
        T.StructField("last_successful_date", T.DateType()),
        T.StructField("updated_at", T.TimestampType()),
    ]
)
