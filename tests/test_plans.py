"""Physical plans: pruning and pushdown reach the scan, hot keys are cut before shuffles."""

from __future__ import annotations

import re
from datetime import date

import pytest

from helpers import daily, grid
from obsgrid.operators import features, ranking
from obsgrid.plans import QUERIES
from obsgrid.session import scratch_path
from obsgrid.sources.tables import read_daily, rebuild_daily
from obsgrid.streaming import refresh


def plan_of(df) -> str:
    return df._jdf.queryExecution().explainString(
        df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    )


@pytest.fixture(scope="module")
def stored(spark):
    root = scratch_path(spark, "plans")
    rebuild_daily(daily(spark, grid(4, 30)), root)
    return root


def test_year_prunes_and_filters_are_pushed(spark, stored):
    table = read_daily(spark, stored)
    plan = plan_of(ranking.city_range(table, [1], date(2026, 1, 2), date(2026, 1, 9)).select("temperature_mean"))
    assert re.search(r"PartitionFilters: \[.*year.*2026", plan)
    assert re.search(r"PushedFilters: \[.*EqualTo\(location_id,1\)", plan)
    columns = re.search(r"ReadSchema: struct<(.*?)>", plan).group(1)
    assert "precipitation_sum" not in columns and "timezone" not in columns


def test_one_city_is_filtered_below_the_fold(spark, sf_dir):
    for name in ("city_series", "city_range"):
        plan = plan_of(QUERIES[name](spark, sf_dir))
        scan = next(x for x in re.findall(r"PushedFilters: \[.*\]", plan) if "l_suppkey" in x)
        assert re.search(r"(EqualTo|In)\(l_suppkey", scan), scan


def test_pair_correlations_unfold_once_per_column(spark, sf_dir):
    tree = plan_of(QUERIES["corr_pairs"](spark, sf_dir)).split("\n\n")[0]
    assert "Expand" not in tree and tree.count("Generate") == 2


def test_features_need_one_shuffle(spark, stored):
    plan = plan_of(features.climate_features(read_daily(spark, stored), ["location_id"]))
    tree = plan.split("\n\n")[0]
    assert tree.count("Exchange") == 1 and "Join" not in tree


def test_keep_last_is_cut_before_the_shuffle(spark, stored):
    table = read_daily(spark, stored)
    plan = plan_of(refresh.upsert(refresh.ranked(table, 0), refresh.ranked(table, 1)))
    tree = plan.split("\n\n")[0]
    assert tree.count("WindowGroupLimit") == 2 and tree.count("Exchange") == 1


@pytest.mark.parametrize(
    "name",
    ["zscore_pop", "nearest_k", "pair_compare", "cluster_deviation", "work_plan", "monthly_precip",
     "date_gaps", "dq_report", "best_model", "global_stats", "catalogue_select", "corr_pairs"],
)
def test_no_cross_joins(spark, sf_dir, name):
    plan = plan_of(QUERIES[name](spark, sf_dir))
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan
