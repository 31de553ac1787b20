"""Top-k reports, keep-first/last, year-over-year change, and simple selections."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from obsgrid.functions.columns import to_long
from obsgrid.functions.labels import DAILY_TABLE_NAMES


def top_cities(
    per_city: DataFrame, metric: str, n: int = 10, descending: bool = True
) -> DataFrame:
    """The n highest or lowest places by a metric; equal values are ordered by name."""
    by = F.col(metric).desc_nulls_last() if descending else F.col(metric).asc_nulls_last()
    return per_city.orderBy(by, "city", "country").limit(n)


def extremes(
    df: DataFrame, ids: Sequence[str], columns: Sequence[str], n: int = 5
) -> DataFrame:
    """The n highest and n lowest rows of every column, as long rows with their rank.

    A rank limit inside each (column, direction) lets Spark cut every task's rows to n
    before they are shuffled.
    """
    long = to_long(df, ids, columns).where(F.col("value").isNotNull())

    def side(direction: str, order: Column) -> DataFrame:
        rank = F.row_number().over(Window.partitionBy("variable").orderBy(order, *ids))
        return (
            long.withColumn("rank", rank)
            .where(F.col("rank") <= n)
            .withColumn("direction", F.lit(direction))
        )

    return side("highest", F.col("value").desc()).unionByName(side("lowest", F.col("value").asc()))


def year_over_year(yearly: DataFrame, keys: Sequence[str], value: str = "value") -> DataFrame:
    """Change against the previous year present; no percentage where that year is zero."""
    order = Window.partitionBy(*keys).orderBy("year")
    before = F.lag(value).over(order)
    return yearly.withColumn("absolute_change", F.col(value) - before).withColumn(
        "percentage_change", F.try_divide(F.col("absolute_change"), before) * 100
    )


def keep_last(rows: DataFrame, keys: Sequence[str], rank: Sequence[str]) -> DataFrame:
    """One row per key: the highest ``rank`` wins, never whichever arrived last.

    Filtering on row_number lets every task reduce a key to one row before the shuffle, so
    a key with very many versions is not gathered in one place.
    """
    order = Window.partitionBy(*keys).orderBy(*[F.col(r).desc_nulls_last() for r in rank])
    return (
        rows.withColumn("_version", F.row_number().over(order))
        .where(F.col("_version") == 1)
        .drop("_version")
    )


def latest_per_city(daily: DataFrame, keys: Sequence[str] = ("location_id",)) -> DataFrame:
    """The most recent row of every place."""
    return keep_last(daily, keys, ["date"])


def ids_of(places: DataFrame, city: str) -> list[int]:
    """The ids of a city's places; a name has a handful of them."""
    found = places.where(F.col("city") == city).select("location_id").distinct().collect()
    return sorted(r["location_id"] for r in found)


def city_series(daily: DataFrame, ids: Sequence[int]) -> DataFrame:
    """The days of places given by id: the filter reaches the scan, below any fold by place."""
    return daily.where(F.col("location_id").isin(*ids)).orderBy("date")


def city_range(daily: DataFrame, ids: Sequence[int], start: date, end: date) -> DataFrame:
    """Their days in an inclusive range. The year bounds prune partitions, which a filter on
    ``date`` alone does not."""
    return city_series(daily, ids).where(
        F.col("year").between(start.year, end.year)
        & F.col("date").between(F.lit(start), F.lit(end))
    )


def in_clusters(places: DataFrame, cluster_ids: Sequence[int]) -> DataFrame:
    return places.where(F.col("cluster_id").isin(*cluster_ids))


def distinct_values(df: DataFrame, *columns: str) -> DataFrame:
    """Sorted choices for a selector."""
    return df.select(*columns).distinct().orderBy(*columns)


def daily_table(daily: DataFrame, digits: int | None = None) -> DataFrame:
    """Daily records under their display names."""

    def shown(column: str) -> Column:
        value = F.col(column)
        return value if digits is None or column == "date" else F.bround(value, digits)

    return daily.select("city", *[shown(c).alias(name) for c, name in DAILY_TABLE_NAMES.items()])


def best_scores(scores: DataFrame) -> DataFrame:
    """The row with the highest silhouette and the row with the lowest cost.

    Equal scores go to the smaller k, which is the one tried first.
    """
    row = F.struct("k", "silhouette", "training_cost")
    best = scores.agg(
        F.max_by(row, F.struct("silhouette", -F.col("k"))).alias("silhouette"),
        F.min_by(row, F.struct("training_cost", "k")).alias("cost"),
    )
    named = F.array(
        F.struct(F.lit("silhouette").alias("criterion"), F.col("silhouette").alias("best")),
        F.struct(F.lit("training_cost").alias("criterion"), F.col("cost").alias("best")),
    )
    return best.select(F.inline(named)).select("criterion", "best.*")
