"""Serving tables: profiles joined with coordinates, feature texts and map rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from obsgrid.functions.columns import to_long
from obsgrid.functions.labels import (
    CLUSTER_COLOURS,
    CLUSTER_NAMES,
    CLUSTER_RGBA,
    FEATURE_TEXTS,
    MARKER_RADIUS,
    lookup,
)
from obsgrid.schema import SERVING_MEASURES, SERVING_NAMES

SERVING_COLUMNS = (
    "location_id",
    "city",
    "country",
    "latitude",
    "longitude",
    "cluster_id",
    *SERVING_MEASURES,
)


def join_one_to_one(left: DataFrame, right: DataFrame, key: str, how: str = "left") -> DataFrame:
    """Join that fails on a duplicate key on either side.

    Duplicates are found in the join itself: each side is folded to one row per key with the
    number of rows it stood for, so the guard costs no extra action. The guard is a filter above
    the join that reads both numbers, so it runs whichever columns are read later.
    """

    def folded(df: DataFrame, side: str) -> DataFrame:
        rest = [c for c in df.columns if c != key]
        return df.groupBy(key).agg(
            F.first(F.struct(*rest)).alias(f"_{side}"), F.count(F.lit(1)).alias(f"_{side}_rows")
        )

    def single(side: str) -> Column:
        message = F.concat(F.lit(f"duplicate {key} on the {side} side: "), F.col(key).cast("string"))
        return F.when(F.coalesce(f"_{side}_rows", F.lit(1)) == 1, F.lit(True)).otherwise(
            F.raise_error(message).cast("boolean")
        )

    return (
        folded(left, "left")
        .join(folded(right, "right"), key, how)
        .where(single("left") & single("right"))
        .select(key, "_left.*", "_right.*")
    )


def serving_table(assigned: DataFrame, places: DataFrame) -> DataFrame:
    """Profile, coordinates and cluster under the serving names, in fixed column order."""
    coordinates = places.select("location_id", "latitude", "longitude")
    joined = join_one_to_one(
        assigned.withColumnsRenamed(SERVING_NAMES).select(
            "location_id", "city", "country", "cluster_id", *SERVING_MEASURES
        ),
        coordinates,
        "location_id",
    )
    return joined.select(*SERVING_COLUMNS)


def unmatched(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Rows whose key the other table does not have."""
    return left.join(right.select(key), key, "left_anti")


def location_details(serving: DataFrame, features: DataFrame) -> DataFrame:
    """Serving rows with their features, matched by city name; clashing names get ``_eda``."""
    clashing = [c for c in features.columns if c in serving.columns and c != "city"]
    renamed = features.withColumnsRenamed({c: f"{c}_eda" for c in clashing})
    return join_one_to_one(serving, renamed, "city")


def feature_long(features: DataFrame, ids: Sequence[str]) -> DataFrame:
    """Features as rows of display name, three-decimal text, unit and meaning."""
    long = to_long(features, ids, FEATURE_TEXTS)
    texts = {
        part: {name: values[i] for name, values in FEATURE_TEXTS.items()}
        for i, part in enumerate(("display_name", "unit", "meaning"))
    }
    variable = F.col("variable")
    return long.select(
        *ids,
        "variable",
        lookup(variable, texts["display_name"]).alias("display_name"),
        F.when(F.col("value").isNull(), "N/A")
        .otherwise(F.format_string("%.3f", "value"))
        .alias("value"),
        lookup(variable, texts["unit"]).alias("unit"),
        lookup(variable, texts["meaning"]).alias("meaning"),
    )


def map_layer(serving: DataFrame) -> DataFrame:
    """What a map needs per place: position, colour, radius and labels."""
    cluster = F.col("cluster_id")
    return serving.select(
        "location_id",
        "city",
        "country",
        "latitude",
        "longitude",
        lookup(cluster, CLUSTER_NAMES).alias("cluster_name"),
        lookup(cluster, CLUSTER_COLOURS).alias("marker_colour"),
        lookup(cluster, {k: ",".join(map(str, v)) for k, v in CLUSTER_RGBA.items()}).alias("marker_rgba"),
        F.lit(MARKER_RADIUS).alias("marker_radius"),
    )


def city_table(serving: DataFrame, digits: int = 2) -> DataFrame:
    """The listing of places, sorted by pattern and name."""
    return serving.select(
        "city",
        "country",
        lookup(F.col("cluster_id"), CLUSTER_NAMES).alias("weather_pattern"),
        *[F.bround(c, digits).alias(c) for c in SERVING_MEASURES],
    ).orderBy("weather_pattern", "city")
