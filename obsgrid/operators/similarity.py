"""Standardised profiles, pair comparison, and nearest profiles."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from obsgrid.functions.columns import euclidean, is_nonfinite, to_long
from obsgrid.schema import SERVING_MEASURES


def standardise(
    profiles: DataFrame,
    columns: Sequence[str],
    population: bool = True,
    suffix: str = "_z",
) -> DataFrame:
    """Add ``<column>_z`` with the population or the sample standard deviation.

    Means and deviations are one scalar struct; a column without variance fails by name.
    """
    deviation = F.stddev_pop if population else F.stddev_samp
    stats = profiles.agg(
        F.struct(
            *[F.avg(c).alias(f"{c}_mean") for c in columns],
            *[deviation(c).alias(f"{c}_dev") for c in columns],
        ).alias("stats")
    ).scalar()

    def scaled(c: str) -> Column:
        spread = F.col(f"_stats.{c}_dev")
        checked = F.when(spread == 0, F.raise_error(F.lit(f"zero variance: {c}"))).otherwise(spread)
        return (F.col(c) - F.col(f"_stats.{c}_mean")) / checked

    return (
        profiles.withColumn("_stats", stats)
        .withColumns({f"{c}{suffix}": scaled(c) for c in columns})
        .drop("_stats")
    )


def standardisation_check(
    standardised: DataFrame, columns: Sequence[str], tolerance: float = 1e-10
) -> DataFrame:
    """Per standardised column: centred on zero, and no non-finite values."""
    rows = F.array(
        *[
            F.struct(
                F.lit(c).alias("variable"),
                (F.abs(F.avg(c)) < tolerance).alias("centred"),
                F.count_if(is_nonfinite(F.col(c))).alias("nonfinite"),
            )
            for c in columns
        ]
    )
    return standardised.agg(rows.alias("rows")).select(F.inline("rows"))


def _only(value: Column, mine: Column, who: str) -> Column:
    """A place's value, provided exactly one row carries its name."""
    found = F.count_if(mine)
    return (
        F.when(found == 1, F.max(F.when(mine, value)))
        .otherwise(F.raise_error(F.concat(F.lit(f"expected one record for {who}, found "), found.cast("string"))))
    )


def _two_sides(standardised: DataFrame, a: str, b: str, columns: Sequence[str]) -> DataFrame:
    """Both places as one row of structs, from a scan filtered to the two names."""
    if a == b:
        raise ValueError("choose two different places")
    fields = ["country", "cluster_id", *columns, *[f"{c}_z" for c in columns]]
    row = F.struct(*fields)
    return standardised.where(F.col("city").isin(a, b)).agg(
        _only(row, F.col("city") == a, a).alias("a"), _only(row, F.col("city") == b, b).alias("b")
    )


def _distance(columns: Sequence[str]) -> Column:
    return euclidean([F.col(f"a.{c}_z") for c in columns], [F.col(f"b.{c}_z") for c in columns])


def pair_distance(
    standardised: DataFrame, a: str, b: str, columns: Sequence[str] = SERVING_MEASURES
) -> DataFrame:
    """Standardised Euclidean distance of two places and whether they share a cluster."""
    return _two_sides(standardised, a, b, columns).select(
        F.lit(a).alias("city_a"),
        F.lit(b).alias("city_b"),
        F.col("a.country").alias("country_a"),
        F.col("b.country").alias("country_b"),
        F.col("a.cluster_id").alias("cluster_a"),
        F.col("b.cluster_id").alias("cluster_b"),
        (F.col("a.cluster_id") == F.col("b.cluster_id")).alias("same_cluster"),
        _distance(columns).alias("standardized_distance"),
    )


def pair_compare(
    standardised: DataFrame, a: str, b: str, columns: Sequence[str] = SERVING_MEASURES
) -> DataFrame:
    """Both values, difference and absolute difference per variable."""
    rows = F.array(
        *[
            F.struct(
                F.lit(c).alias("variable"),
                F.col(f"a.{c}").alias("city_a"),
                F.col(f"b.{c}").alias("city_b"),
            )
            for c in columns
        ]
    )
    return (
        _two_sides(standardised, a, b, columns)
        .select(F.inline(rows))
        .withColumn("difference", F.col("city_a") - F.col("city_b"))
        .withColumn("absolute_difference", F.abs("difference"))
    )


def distance_contributions(
    standardised: DataFrame, a: str, b: str, columns: Sequence[str] = SERVING_MEASURES
) -> DataFrame:
    """Share of each variable in the squared distance; all zero for identical profiles."""
    distance = _distance(columns)
    rows = F.array(
        *[
            F.struct(
                F.lit(c).alias("variable"),
                F.abs(F.col(f"a.{c}_z") - F.col(f"b.{c}_z")).alias("standardized_difference"),
            )
            for c in columns
        ]
    )
    total = F.col("distance") * F.col("distance")
    return (
        _two_sides(standardised, a, b, columns)
        .withColumn("distance", distance)
        .select("distance", F.inline(rows))
        .select(
            "variable",
            "standardized_difference",
            F.when(total > 0, F.pow("standardized_difference", F.lit(2.0)) / total)
            .otherwise(0.0)
            .alias("distance_contribution"),
        )
        .orderBy(F.col("distance_contribution").desc(), "variable")
    )


def nearest_to(
    standardised: DataFrame, city: str, n: int = 5, columns: Sequence[str] = SERVING_MEASURES
) -> DataFrame:
    """The n places whose profiles are closest to one place's.

    The target is a scalar struct, so the table is read past it without a join; the report
    keeps n rows per task.
    """
    mine = F.col("city") == city
    target = (
        standardised.where(mine)
        .agg(_only(F.struct(*[f"{c}_z" for c in columns]), mine, city).alias("target"))
        .scalar()
    )
    return (
        standardised.where(F.col("city") != city)
        .withColumn("_t", target)
        .withColumn(
            "distance",
            euclidean([F.col(f"{c}_z") for c in columns], [F.col(f"_t.{c}_z") for c in columns]),
        )
        .orderBy("distance", "city")
        .limit(n)
        .select("city", "country", "cluster_id", "distance")
    )


def cluster_deviation(
    places: DataFrame,
    ids: Sequence[str] = ("location_id", "city", "cluster_id"),
    columns: Sequence[str] = SERVING_MEASURES,
) -> DataFrame:
    """Each place against the mean of its cluster, one row per variable.

    Cluster means are aggregated first and joined back: there are as many as clusters, so
    they are broadcast, and no cluster has to be gathered in one task.
    """
    means = places.groupBy("cluster_id").agg(*[F.avg(c).alias(c) for c in columns])
    long_means = to_long(means, ["cluster_id"], columns, "variable", "cluster_average")
    return (
        to_long(places, list(ids), columns, "variable", "location_value")
        .join(F.broadcast(long_means), ["cluster_id", "variable"])
        .withColumn("difference", F.col("location_value") - F.col("cluster_average"))
        .select(*ids, "variable", "location_value", "cluster_average", "difference")
    )
