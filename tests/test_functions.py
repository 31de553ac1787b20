from __future__ import annotations

import math
import random

import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from obsgrid.functions.columns import finite, is_nonfinite
from obsgrid.functions.labels import weather_text, with_unit
from obsgrid.functions.ordinals import batch_of, with_ordinal
from obsgrid.functions.quantiles import exact_quantiles
from obsgrid.operators import describe
from obsgrid.streaming import workplan

PROBABILITIES = {"q25": 0.25, "median": 0.5, "q75": 0.75, "p99": 0.99, "least_": 0.0, "most_": 1.0}


def _check(spark, values, accuracy):
    df = spark.createDataFrame([(v,) for v in values], "x double")
    got = exact_quantiles(df.repartition(5), ["x"], PROBABILITIES, accuracy).first()
    kept = [v for v in values if v is not None]
    assert got["count"] == len(kept)
    for name, p in PROBABILITIES.items():
        assert got[name] == pytest.approx(float(np.quantile(kept, p)), rel=1e-12, abs=1e-12)


def test_quantiles_where_a_third_of_the_rows_are_equal(spark):
    rng = random.Random(1)
    values = [7.0] * 4000 + [rng.gauss(0, 50) for _ in range(8000)] + [None] * 50
    _check(spark, values, accuracy=200)


def test_quantiles_with_heavy_outliers(spark):
    rng = random.Random(2)
    values = [math.exp(rng.gauss(0, 6)) for _ in range(9000)]
    _check(spark, values, accuracy=500)


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(values=st.lists(st.floats(-1e6, 1e6), min_size=1, max_size=40))
def test_quantiles_of_small_inputs(spark, values):
    _check(spark, values, accuracy=100)


def test_ordinals_are_consecutive_in_any_layout(spark):
    ids = [i * i for i in range(1, 400)]
    for parts in (1, 7):
        df = spark.createDataFrame([(i,) for i in ids], "location_id long").repartition(parts)
        got = with_ordinal(df, F.floor(F.col("location_id") / 1000), [F.col("location_id")])
        pairs = sorted((r["location_id"], r["ordinal"]) for r in got.collect())
        assert pairs == [(i, n) for n, i in enumerate(ids, 1)]
    batches = got.groupBy(batch_of(F.col("ordinal"), 20).alias("b")).count().collect()
    assert sorted(r["count"] for r in batches) == [19] + [20] * 19


def test_places_are_numbered_in_even_ranges_however_their_ids_cluster(spark):
    ids = [*range(10**12, 10**12 + 3000), *range(500), 7 * 10**15]
    df = spark.createDataFrame([(i,) for i in ids], "location_id long")
    got = workplan.number_places(df, 20).orderBy("location_id").collect()
    assert [r["ordinal"] for r in got] == list(range(1, len(ids) + 1))
    assert [r["location_id"] for r in got] == sorted(ids)


def test_nonfinite_and_labels(spark):
    df = spark.createDataFrame(
        [(1.0,), (float("nan"),), (float("inf"),), (float("-inf"),), (None,)], "x double"
    )
    rows = df.select(finite(F.col("x")).alias("f"), is_nonfinite(F.col("x")).alias("n")).collect()
    assert [r["f"] for r in rows] == [1.0, None, None, None, None]
    assert [r["n"] for r in rows] == [False, True, True, True, False]
    shown = df.select(with_unit(F.col("x"), 1, " mm").alias("t")).collect()
    assert shown[0]["t"] == "1.0 mm" and shown[4]["t"] == "N/A"
    codes = spark.createDataFrame([(95,), (12,), (None,)], "c int").select(weather_text(F.col("c")).alias("t"))
    assert [r["t"] for r in codes.collect()] == ["Thunderstorm", "Unknown condition", "Unknown condition"]


def test_empty_and_null_periods(spark):
    df = spark.createDataFrame(
        [("a", None, None), ("a", None, 2.0)], "city string, precipitation_sum double, temperature_mean double"
    ).withColumn("date", F.to_date(F.lit("2024-02-03")))
    got = describe.monthly_series(df, ["city"], ["precipitation_sum", "temperature_mean"]).first()
    assert (got["precipitation_sum"], got["temperature_mean"]) == (0.0, 2.0)
    places = spark.createDataFrame([], "country string, cluster_id int, temperature_c double")
    assert tuple(describe.overview(places).first()) == (0, 0, 0, None)


# The eight places of the sample table.
SAMPLE = [
    ("Colombo", 28.4, 2200.0, 78.0),
    ("London", 11.2, 600.0, 75.0),
    ("Tokyo", 17.8, 1500.0, 70.0),
    ("Cairo", 24.3, 20.0, 45.0),
    ("Sydney", 19.1, 1200.0, 68.0),
    ("Mumbai", 27.0, 2200.0, 80.0),
    ("Moscow", 5.5, 700.0, 70.0),
    ("Dubai", 29.0, 100.0, 40.0),
]


def test_sample_table_through_a_view(spark):
    spark.createDataFrame(SAMPLE, "city string, temperature double, rainfall double, humidity double"
                          ).createOrReplaceTempView("sample")
    warm = spark.sql("SELECT city FROM sample WHERE temperature > 20 ORDER BY temperature DESC")
    assert [r["city"] for r in warm.collect()] == ["Dubai", "Colombo", "Mumbai", "Cairo"]
    means = describe.averages(spark.table("sample"), {"t": "temperature", "r": "rainfall"}).first()
    assert means["t"] == pytest.approx(20.2875) and means["r"] == pytest.approx(1065.0)
