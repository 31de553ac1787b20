"""Display names, units and code texts, and the lookups over them."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

# Code texts, pattern names, colours and feature descriptions as displayed.
WEATHER_CODES = {
    0: "Clear sky",
    1: "Mainly clear",
    2: "Partly cloudy",
    3: "Overcast",
    45: "Fog",
    48: "Depositing rime fog",
    51: "Light drizzle",
    53: "Moderate drizzle",
    55: "Dense drizzle",
    56: "Light freezing drizzle",
    57: "Dense freezing drizzle",
    61: "Slight rain",
    63: "Moderate rain",
    65: "Heavy rain",
    66: "Light freezing rain",
    67: "Heavy freezing rain",
    71: "Slight snow fall",
    73: "Moderate snow fall",
    75: "Heavy snow fall",
    77: "Snow grains",
    80: "Slight rain showers",
    81: "Moderate rain showers",
    82: "Violent rain showers",
    85: "Slight snow showers",
    86: "Heavy snow showers",
    95: "Thunderstorm",
    96: "Thunderstorm with slight hail",
    99: "Thunderstorm with heavy hail",
}
UNKNOWN_CONDITION = "Unknown condition"

CLUSTER_NAMES = {
    0: "Hot, Wet & Humid",
    1: "Cool, Elevated / Interior",
    2: "Cooler, Windier / Mid-Latitude-Coastal",
    3: "Hot, Dry & Windy",
}
CLUSTER_COLOURS = {
    0: "#3296FF",
    1: "#46C86E",
    2: "#B46EFF",
    3: "#FF5555",
}
CLUSTER_RGBA = {
    0: [50, 150, 255, 220],
    1: [70, 200, 110, 220],
    2: [180, 110, 255, 220],
    3: [255, 85, 85, 230],
}
MARKER_RADIUS = 30000

DAILY_TABLE_NAMES = {
    "date": "Date",
    "temperature_mean": "Mean Temperature (°C)",
    "temperature_max": "Maximum Temperature (°C)",
    "temperature_min": "Minimum Temperature (°C)",
    "precipitation_sum": "Precipitation (mm)",
    "relative_humidity_mean": "Humidity (%)",
    "wind_speed_mean": "Wind Speed (km/h)",
    "surface_pressure_mean": "Surface Pressure (hPa)",
}

# feature -> (display name, unit, meaning)
FEATURE_TEXTS = {
    "mean_temperature": (
        "Mean temperature", "°C", "10-year average daily mean temperature."),
    "temperature_std": (
        "Temperature variability", "°C", "Standard deviation of daily mean temperature."),
    "mean_diurnal_range": (
        "Mean diurnal temperature range", "°C",
        "Average daily difference between maximum and minimum temperature."),
    "temperature_p10": (
        "Temperature 10th percentile", "°C",
        "Temperature below which approximately 10% of daily values fall."),
    "temperature_p90": (
        "Temperature 90th percentile", "°C",
        "Temperature below which approximately 90% of daily values fall."),
    "temperature_p90_p10_range": (
        "Temperature P90-P10 range", "°C",
        "Difference between the 90th and 10th temperature percentiles."),
    "temperature_seasonality": (
        "Temperature seasonality", "°C",
        "Difference between the warmest and coldest monthly mean temperatures."),
    "annual_precipitation": (
        "Average annual precipitation", "mm/year",
        "Average annual precipitation over the 10-year historical period."),
    "precipitation_std": (
        "Precipitation variability", "mm/day", "Standard deviation of daily precipitation."),
    "wet_day_frequency": (
        "Wet-day frequency", "proportion", "Proportion of days classified as wet."),
    "maximum_daily_precipitation": (
        "Maximum daily precipitation", "mm/day", "Maximum observed daily precipitation."),
    "precipitation_seasonality": (
        "Precipitation seasonality", "mm",
        "Difference between maximum and minimum monthly precipitation."),
    "mean_humidity": (
        "Mean relative humidity", "%", "10-year average relative humidity."),
    "humidity_std": (
        "Humidity variability", "%", "Standard deviation of daily relative humidity."),
    "mean_wind": (
        "Mean wind speed", "km/h", "10-year average wind speed."),
    "wind_std": (
        "Wind-speed variability", "km/h", "Standard deviation of daily wind speed."),
}

STATISTIC_LABELS = {
    "count": "Observations",
    "mean": "Mean",
    "std": "Standard deviation",
    "minimum": "Minimum",
    "q1": "25th percentile",
    "median": "Median",
    "q3": "75th percentile",
    "maximum": "Maximum",
    "range": "Range",
}


def lookup(code: Column, texts: Mapping, default: str | None = None) -> Column:
    """Text of a code from a small fixed dictionary, evaluated inside the projection."""
    pairs = [F.lit(part) for item in texts.items() for part in item]
    found = F.try_element_at(F.create_map(*pairs), code)
    return found if default is None else F.coalesce(found, F.lit(default))


def weather_text(code: Column) -> Column:
    return lookup(code.cast("int"), WEATHER_CODES, UNKNOWN_CONDITION)


def day_or_night(flag: Column) -> Column:
    return F.when(flag == 1, "Day").when(flag == 0, "Night").otherwise("N/A")


def city_label(city: Column, country: Column) -> Column:
    return F.concat_ws(" — ", city, country)


def member_label(city: Column, country: Column) -> Column:
    return F.concat(city, F.lit(" ("), country, F.lit(")"))


def with_unit(value: Column, digits: int, unit: str) -> Column:
    """Fixed-decimal text with its unit; a missing value reads N/A."""
    return F.when(value.isNull(), "N/A").otherwise(
        F.format_string(f"%.{digits}f{unit}", value.cast("double"))
    )
