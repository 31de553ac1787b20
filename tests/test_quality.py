from __future__ import annotations

import functools
import hashlib
import operator
from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from helpers import START, as_set, daily, grid, row
from obsgrid.operators import quality
from obsgrid.operators.serving import join_one_to_one
from obsgrid.plans import quality as plans
from obsgrid.schema import MEASURE_NAMES
from obsgrid.sources.tables import require_columns
from obsgrid.sources.views import readings


def failed(report) -> set:
    return {r["rule"] for r in report.where("status = 'FAIL'").collect()}


def test_a_complete_table_passes(spark):
    table = daily(spark, grid())
    report = quality.daily_report(table, "d", 3, str(START), str(START + timedelta(days=4)))
    assert failed(report) == set()
    assert quality.date_gaps(table).count() == 0
    assert quality.continuity(table).where("complete").count() == 3


@pytest.mark.parametrize(
    "change, rules",
    [
        (lambda rows: rows + [rows[0]], {"rows", "duplicates", "most_rows_per_location"}),
        (lambda rows: rows[:-1], {"rows", "fewest_rows_per_location", "fewest_days_per_location"}),
        (lambda rows: rows[1:] + [row(1, START, temperature_mean=None)], {"missing_values"}),
        (lambda rows: rows[1:] + [row(1, START, wind_speed_mean=float("nan"))], {"missing_values"}),
        (lambda rows: rows[1:] + [row(1, START, temperature_min=26.0)], {"temperature_consistency"}),
        (lambda rows: rows[1:] + [row(1, START, temperature_max=24.0)], {"temperature_consistency"}),
    ],
)
def test_planted_defects(spark, change, rules):
    report = quality.daily_report(daily(spark, change(grid())), "d", 3)
    assert failed(report) == rules


def test_gaps_inside_and_at_both_ends(spark):
    days = [START + timedelta(days=d) for d in range(10)]
    rows = [row(1, d) for d in days] + [row(2, days[i]) for i in (2, 3, 7)]
    table = daily(spark, rows)
    gaps = {(r["gap_start"], r["gap_end"], r["missing_days"]) for r in quality.date_gaps(table).collect()}
    assert gaps == {(days[0], days[1], 2), (days[4], days[6], 3), (days[8], days[9], 2)}
    assert {r["date"] for r in quality.missing_dates(quality.date_gaps(table)).collect()} == {
        days[i] for i in (0, 1, 4, 5, 6, 8, 9)
    }


def test_duplicate_metrics_differ(spark):
    rows = grid(1, 2) + [row(1, START)] * 3
    assert quality.duplicate_extra_rows(daily(spark, rows)).first()["extra_rows"] == 3
    assert [r["copies"] for r in quality.duplicate_groups(daily(spark, rows)).collect()] == [4]


def test_fingerprint_ignores_order_and_sees_changes(spark):
    rows = grid(3, 20)
    table = daily(spark, rows)
    shuffled = daily(spark, rows[::-1]).repartition(7)
    assert quality.same_content(table, shuffled)
    assert not quality.same_content(table, daily(spark, rows[1:] + [row(1, START, elevation=6.0)]))
    assert not quality.same_content(table, daily(spark, rows + rows[:2]))


def test_fingerprint_query_digests_all_readings_and_those_with_missing_values(spark, tmp_path):
    lines = [(i, START + timedelta(days=d), 100.0 * i + d, 2.0, 0.05, 0.01) for i in range(1, 14) for d in range(3)]
    names = "l_suppkey long, l_shipdate date, l_extendedprice double, l_quantity double, l_discount double, l_tax double"
    spark.createDataFrame(lines, names).write.parquet(f"{tmp_path}/lineitem.parquet")

    def digest(rows):
        hashes = []
        for row in rows:
            cells = "|".join("~" if row[c] is None else f"={row[c]}" for c in plans.DIGEST_COLUMNS)
            hashes.append(int(hashlib.md5(cells.encode()).hexdigest()[:15], 16))
        return len(hashes), str(sum(hashes)), functools.reduce(operator.xor, hashes)

    steps = [r.asDict() for r in plans._steps(readings(spark, str(tmp_path))).collect()]
    missing = [
        r | {m: None for i, m in enumerate(MEASURE_NAMES) if r["location_id"] % (i + 5) == 0} for r in steps
    ]
    found = plans.fingerprint(spark, str(tmp_path)).collect()
    got = {r["dataset"]: (r["rows"], r["hash_sum"], r["hash_xor"]) for r in found}
    assert len(found) == 2 and got == {"steps": digest(steps), "missing": digest(missing)}


def test_required_columns(spark):
    with pytest.raises(ValueError, match="nothing"):
        require_columns(daily(spark, grid()), ["date", "nothing"])


def test_assignment_report(spark):
    good = spark.createDataFrame([(i, i % 4) for i in range(8)], "location_id long, cluster_id int")
    assert failed(quality.assignment_report(good, "c", 4, 8)) == set()
    bad = good.withColumn("cluster_id", F.when(F.col("cluster_id") == 3, 9).otherwise(F.col("cluster_id")))
    assert failed(quality.assignment_report(bad, "c", 4, 8)) == {"clusters_used", "ids_outside_range"}
    sizes = [r["count"] for r in good.groupBy("cluster_id").count().orderBy("cluster_id").collect()]
    assert failed(quality.assignment_report(good, "c", 4, 8, sizes)) == set()
    sizes[1] += 1
    assert failed(quality.assignment_report(good, "c", 4, 8, sizes)) == {"size_1"}


def test_one_to_one_join(spark):
    left = spark.createDataFrame([(1, "a"), (2, "b")], "k long, x string")
    right = spark.createDataFrame([(1, "p")], "k long, y string")
    assert as_set(join_one_to_one(left, right, "k")) == {(1, "a", "p"), (2, "b", None)}
    with pytest.raises(Exception, match="duplicate k on the right side: 1"):
        join_one_to_one(left, right.union(right), "k").collect()
    for action in (lambda df: df.count(), lambda df: df.select("k").collect()):
        with pytest.raises(Exception, match="duplicate k"):
            action(join_one_to_one(left, right.union(right), "k"))
        with pytest.raises(Exception, match="duplicate k"):
            action(join_one_to_one(left.union(left), right, "k"))
    with pytest.raises(Exception, match="duplicate k on the left side: 2"):
        join_one_to_one(left.union(left.where("k = 2")), right, "k").collect()


def payload(spark, locations, start=date(2024, 1, 1), end=date(2024, 1, 2)):
    from obsgrid.schema import PAYLOAD_SCHEMA
    from pyspark.sql import types as T

    schema = T.StructType(
        [T.StructField("work_id", T.StringType()), T.StructField("start_date", T.DateType()),
         T.StructField("end_date", T.DateType()), T.StructField("locations", PAYLOAD_SCHEMA)]
    )
    return spark.createDataFrame([("w", start, end, locations)], schema)


def location(time=("2024-01-01", "2024-01-02"), **changes):
    n = len(time)
    days = [list(time)] + [[1.0] * n for _ in range(7)]
    for index, values in changes.pop("series", {}).items():
        days[index] = values
    base = {"latitude": 1.0, "longitude": 2.0, "timezone": "UTC", "elevation": None, "daily": tuple(days)}
    base.update(changes)
    return tuple(base[k] for k in ("latitude", "longitude", "timezone", "elevation", "daily"))


@pytest.mark.parametrize(
    "locations, rules",
    [
        ([location()], set()),
        ([location(), location()], {"location_count"}),
        ([location(timezone=None)], {"missing_timezone"}),
        ([location(daily=None)], {"missing_daily"}),
        ([location(series={5: None})], {"missing_relative_humidity_2m_mean"}),
        ([location(series={5: [1.0]})], {"length_relative_humidity_2m_mean"}),
        ([location(time=("2024-01-01",))], {"day_count", "last_date", "exact_dates"}),
        ([location(time=("2024-01-01", "2024-01-01"))], {"duplicate_dates", "last_date", "exact_dates"}),
        ([location(time=("2023-12-31", "2024-01-02"))], {"first_date", "exact_dates"}),
        ([location(time=("2024-01-02", "2024-01-01"))], {"first_date", "last_date", "exact_dates"}),
        ([location(time=())], {"day_count", "no_dates", "exact_dates"}),
    ],
)
def test_payload_rules(spark, locations, rules):
    found = quality.payload_violations(payload(spark, locations), F.lit(1), strict_dates=True)
    assert {r["rule"] for r in found.collect()} == rules
