"""Small column expressions used across operators."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed value: how a work unit is named.
WORK_ID_FORMAT = "batch_%04d__%s__%s"
WORK_ID_PATTERN = r"batch_(\d{4,})__(\d{4}-\d{2}-\d{2})__(\d{4}-\d{2}-\d{2})"


def finite(column: Column) -> Column:
    """NaN and infinities become NULL, so averages skip them."""
    return F.when(F.abs(column) < F.lit(float("inf")), column)


def is_nonfinite(column: Column) -> Column:
    """True for NaN and infinities, false for NULL and ordinary numbers."""
    return F.coalesce(F.isnan(column) | (F.abs(column) == F.lit(float("inf"))), F.lit(False))


def count_if(condition: Column) -> Column:
    """Number of rows meeting a condition; zero rather than NULL on empty input."""
    return F.count(F.when(condition, 1))


def window_days(start: Column, end: Column) -> Column:
    """Days in an inclusive window."""
    return F.datediff(end, start) + 1


def work_id(batch: Column, start: Column, end: Column) -> Column:
    return F.format_string(
        WORK_ID_FORMAT,
        batch.cast("int"),
        F.date_format(start, "yyyy-MM-dd"),
        F.date_format(end, "yyyy-MM-dd"),
    )


def euclidean(left: Sequence[Column], right: Sequence[Column]) -> Column:
    total = F.lit(0.0)
    for a, b in zip(left, right, strict=True):
        total = total + (a - b) * (a - b)
    return F.sqrt(total)


def city_key(iso3: Column, city: Column) -> Column:
    """Identity of a city name inside a country, ignoring case and outer blanks."""
    return F.concat_ws("::", F.upper(F.trim(iso3)), F.lower(F.trim(city)))


def one_row(stats: DataFrame, *columns: str) -> Column:
    """A single-row aggregate as a scalar struct: no join, computed once per query."""
    return stats.select(F.struct(*columns).alias("stats")).scalar()


def to_long(
    df: DataFrame,
    ids: Sequence[str],
    values: Iterable[str],
    name: str = "variable",
    value: str = "value",
) -> DataFrame:
    """Wide columns to (name, value) rows, NULLs kept."""
    values = list(values)
    return df.select(*ids, *[F.col(v).cast("double").alias(v) for v in values]).unpivot(
        list(ids), values, name, value
    )
