"""The views over the test tables: tasks hold a bounded number of lines, windows stay together."""

from __future__ import annotations

import re
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from helpers import as_set
from obsgrid.operators import quality
from obsgrid.plans import QUERIES
from obsgrid.session import scratch_path
from obsgrid.sources import views
from test_plans import plan_of

LINES = (
    "l_suppkey long, l_shipdate timestamp, l_quantity double, l_extendedprice double, "
    "l_discount double, l_tax double"
)
FIRST = datetime(1999, 12, 1)


@pytest.fixture(scope="module")
def shipped(spark):
    """Lines of five places, one hot, one without a key, some days twice, some lines without a day."""
    rows = [
        (None if i % 11 == 0 else 1 if i % 2 else i % 5, None if i % 13 == 0 else FIRST + timedelta(days=i % 70),
         1.0 + i % 9, 100.0 + i, 0.05, 0.02)
        for i in range(400)
    ]
    root = scratch_path(spark, "tables")
    spark.createDataFrame(rows, LINES).write.parquet(f"{root}/lineitem.parquet")
    return root, rows


def tasks_of(df) -> list[int]:
    return [int(n) for n in re.findall(r"hashpartitioning\(.*?, (\d+)\), REPARTITION_BY_NUM", plan_of(df))]


def test_more_lines_take_more_tasks(spark, shipped, monkeypatch):
    root, rows = shipped
    monkeypatch.setattr(views, "TASK_LINES", 10)
    found = views.readings(spark, root)
    assert tasks_of(found) == [40]
    want = {(i, d.date()) if d else (i, None) for i, d, *_ in rows}
    assert as_set(found.select("location_id", "date")) == {(d, i) for i, d in want}
    assert found.agg(F.sum("precipitation_sum")).first()[0] == sum(r[2] for r in rows)
    for checked in (quality.duplicate_groups, quality.duplicate_extra_rows, quality.continuity):
        assert 40 in tasks_of(checked(found))


@pytest.mark.parametrize("name", ["dup_extra_rows", "dup_groups", "latest_per_city", "date_continuity"])
def test_tasks_follow_the_lines(spark, sf_dir, monkeypatch, name):
    monkeypatch.setattr(views, "TASK_LINES", 100)
    lines = spark.read.parquet(f"{sf_dir}/lineitem.parquet").count()
    assert -(-lines // 100) in tasks_of(QUERIES[name](spark, sf_dir))


def test_windows_of_a_place_are_in_one_task(spark, shipped):
    root, _ = shipped
    start = F.date_add(F.lit(FIRST.date()), (F.floor(F.datediff("date", F.lit(FIRST.date())) / 30) * 30).cast("int"))
    whole, cut = views.readings(spark, root), views.readings(spark, root, start)
    assert as_set(cut.drop("start_date")) == as_set(whole)
    numbered = cut.where("date is not null").withColumn("task", F.spark_partition_id())
    spread = numbered.groupBy("location_id", "start_date").agg(
        F.count_distinct("task").alias("tasks"), F.max(F.datediff("date", "start_date")).alias("last")
    )
    assert {(r["tasks"], r["last"] < 30) for r in spread.collect()} == {(1, True)}
    folded = cut.groupBy("location_id", "start_date").agg(F.collect_list("date"))
    assert plan_of(folded).split("\n\n")[0].count("Exchange") == 1
