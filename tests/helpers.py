"""Small observation tables for planted-defect tests."""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import DataFrame, SparkSession

from obsgrid.schema import CATALOGUE_SCHEMA, DAILY_SCHEMA

START = date(2025, 12, 28)


def places(spark: SparkSession, n: int = 3) -> DataFrame:
    rows = [
        (i, f"City {i}", f"City {i}", "Korea, North" if i == 1 else f"Land {i}", f"L{i}", f"LA{i}",
         "Area", None, 10.0 + i, 20.0 + i, 1000.0 * i)
        for i in range(1, n + 1)
    ]
    return spark.createDataFrame(rows, CATALOGUE_SCHEMA)


def row(i: int, day: date, **changes):
    values = {
        "location_id": i, "city": f"City {i}", "city_ascii": f"City {i}", "country": f"Land {i}",
        "iso2": f"L{i}", "iso3": f"LA{i}", "admin_name": "Area", "capital": None,
        "source_latitude": 10.0 + i, "source_longitude": 20.0 + i, "model_latitude": 10.0 + i,
        "model_longitude": 20.0 + i, "timezone": "UTC", "elevation": 5.0, "date": day,
        "temperature_mean": 25.0, "temperature_max": 30.0, "temperature_min": 20.0,
        "precipitation_sum": 1.0, "relative_humidity_mean": 70.0, "wind_speed_mean": 10.0,
        "surface_pressure_mean": 1000.0, "year": day.year,
    }
    values.update(changes)
    return tuple(values[n] for n in DAILY_SCHEMA.fieldNames())


def daily(spark: SparkSession, rows) -> DataFrame:
    return spark.createDataFrame(list(rows), DAILY_SCHEMA)


def grid(n: int = 3, days: int = 5, start: date = START, **changes):
    return [row(i, start + timedelta(days=d), **changes) for i in range(1, n + 1) for d in range(days)]


def as_set(df: DataFrame) -> set:
    return {tuple(r) for r in df.select(*sorted(df.columns)).collect()}
