from __future__ import annotations

import json
import os
from datetime import date, timedelta

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from helpers import START, as_set, daily, grid, places, row
from obsgrid.operators.quality import same_content
from obsgrid.schema import MEASURES
from obsgrid.session import scratch_path
from obsgrid.sources import payloads, snapshots, tables
from obsgrid.streaming import ingest, refresh, workplan

AS_OF = START + timedelta(days=9)


def test_windows_cover_the_span_exactly(spark):
    plan = workplan.work_plan(
        workplan.number_places(places(spark, 45)), date(2016, 1, 1), date(2025, 12, 31)
    )
    assert plan.count() == 3 * 261
    assert plan.agg(F.sum("days")).first()[0] == 3 * 3653
    last = plan.orderBy(F.col("start_date").desc(), "batch_number").first()
    assert last["end_date"] == date(2025, 12, 31)
    assert plan.where("work_id = 'batch_0003__2016-01-01__2016-01-14'").first()["locations"] == 5


@settings(max_examples=4, deadline=None, suppress_health_check=list(HealthCheck))
@given(seed=st.integers(0, 10_000))
def test_upsert_does_not_depend_on_order(spark, seed):
    base = [row(i % 5, START, precipitation_sum=float(i)) for i in range(10)]
    new = [row(i % 7, START, precipitation_sum=100.0 + i) for i in range(14)]
    first = refresh.upsert(refresh.ranked(daily(spark, base), 0), refresh.ranked(daily(spark, new), 1))
    shuffled = refresh.upsert(
        refresh.ranked(daily(spark, new[::-1]).orderBy(F.rand(seed)).repartition(3), 1),
        refresh.ranked(daily(spark, base[::-1]), 0),
    )
    assert as_set(first) == as_set(shuffled)
    assert first.count() == 7
    assert first.where("precipitation_sum < 100").count() == 0


def _stored(spark, rows):
    root = scratch_path(spark, "t")
    snapshots.rebuild(spark, daily(spark, rows), root)
    return root


def test_catch_up_across_the_end_of_a_year(spark):
    everything = grid(3, 9)
    root, state = _stored(spark, grid(3, 3)), scratch_path(spark, "s")
    calls = []

    def fetch(start, end):
        calls.append((start, end))
        return daily(spark, everything).where(F.col("date").between(F.lit(start), F.lit(end)))

    outcome = refresh.refresh(spark, root, state, AS_OF, fetch, 3)
    assert (outcome.status, outcome.days, outcome.rows) == ("updated", 6, 18)
    assert calls == [(START + timedelta(days=3), START + timedelta(days=8))]
    assert same_content(snapshots.read(spark, root), daily(spark, everything))
    years = snapshots.files(spark, root).select("year").distinct()
    assert sorted(r["year"] for r in years.collect()) == [2025, 2026]
    assert refresh.read_state(spark, state) == AS_OF - timedelta(days=1)

    again = refresh.refresh(spark, root, state, AS_OF, fetch, 3)
    assert again.status == "current" and len(calls) == 1


def test_a_broken_batch_changes_nothing(spark):
    root, state = _stored(spark, grid(3, 3)), scratch_path(spark, "s")
    before = sorted(os.listdir(root))
    for rows, rule in (
        (grid(2, 9), "new_rows"),
        (grid(3, 9, temperature_mean=None), "missing_values"),
        (grid(3, 9, temperature_mean=99.0), "temperature_consistency"),
    ):
        fetch = lambda a, b, rows=rows: daily(spark, rows).where(F.col("date").between(F.lit(a), F.lit(b)))
        outcome = refresh.refresh(spark, root, state, AS_OF, fetch, 3)
        assert outcome.status == "rejected" and rule in outcome.failed_rules
    assert sorted(os.listdir(root)) == before
    assert same_content(snapshots.read(spark, root), daily(spark, grid(3, 3)))
    assert refresh.read_state(spark, state) is None


def test_the_running_day_is_never_ingested(spark):
    table = daily(spark, grid(1, 5))
    kept = refresh.complete_days(table, START + timedelta(days=2))
    assert kept.agg(F.max("date")).first()[0] == START + timedelta(days=1)


def test_publish_skips_unchanged_years(spark):
    root = _stored(spark, grid(2, 6))
    assert refresh.publish(spark, snapshots.read(spark, root), root) is False
    changed = daily(spark, grid(2, 6, elevation=9.0))
    assert refresh.publish(spark, changed, root) is True
    assert same_content(snapshots.read(spark, root), changed)


def test_resume_decisions(spark):
    plan = spark.createDataFrame([(u,) for u in "abcdef"], "work_id string")
    manifest = spark.createDataFrame(
        [("a", "success"), ("b", "success"), ("c", "failed"), ("d", "failed")], "work_id string, status string"
    )
    files = spark.createDataFrame(
        [("a", True), ("c", True), ("d", False), ("e", True)], "work_id string, valid boolean"
    )
    got = {r["work_id"]: r["action"] for r in workplan.resume_actions(plan, manifest, files).collect()}
    assert got == {"a": "skip", "b": "refetch", "c": "adopt", "d": "replace", "e": "adopt", "f": "fetch"}
    assert {r["work_id"] for r in workplan.pending_units(plan, manifest).collect()} == set("cdef")


def test_manifest_keeps_the_latest_record(spark):
    path = scratch_path(spark, "manifest")
    assert workplan.read_manifest(spark, path).count() == 0
    schema = "work_id string, status string, error string"
    workplan.record_units(spark.createDataFrame([("a", "failed", "timeout"), ("b", "success", None)], schema), path)
    workplan.record_units(spark.createDataFrame([("a", "success", None)], schema), path)
    manifest = workplan.read_manifest(spark, path)
    assert {(r["work_id"], r["status"], r["error"]) for r in manifest.collect()} == {
        ("a", "success", None), ("b", "success", None)
    }
    assert tuple(workplan.manifest_summary(manifest).first()) == (2, 2, 0)


def _location(days, rain):
    series = {m.variable: [1.0] * len(days) for m in MEASURES}
    series["precipitation_sum"] = [rain] * len(days)
    return {"latitude": 1.0, "longitude": 2.0, "timezone": "UTC", "elevation": 3.0,
            "daily": {"time": days, **series}}


def test_stream_of_named_files(spark, tmp_path):
    raw = tmp_path / "raw"
    raw.mkdir()
    numbered = workplan.number_places(places(spark, 3), 2)
    root, checkpoint, quarantine = (scratch_path(spark, n) for n in ("t", "c", "q"))

    def run():
        ingest.ingest(spark, str(raw), root, quarantine, checkpoint, numbered, 2, max_files=2)

    days = ["2024-12-31", "2025-01-01"]
    (raw / "batch_0001__2024-12-31__2025-01-01.json").write_text(
        json.dumps([_location(days, 1.0), _location(days, 2.0)], indent=1)
    )
    (raw / "batch_0002__2024-12-31__2025-01-01.json").write_text(json.dumps(_location(days, 3.0)))
    (raw / "notes.json").write_text("[]")
    (raw / "batch_0009__2024-12-31__2025-01-01.json").write_text("{broken")
    run()
    table = snapshots.read(spark, root)
    got = {(r["location_id"], str(r["date"]), r["precipitation_sum"]) for r in table.collect()}
    assert got == {(i, d, float(i)) for i in (1, 2, 3) for d in days}
    bad = spark.read.option("basePath", quarantine).parquet(quarantine)
    assert {(os.path.basename(r["path"]), r["reason"]) for r in bad.collect()} == {
        ("notes.json", "name"), ("batch_0009__2024-12-31__2025-01-01.json", "json"),
    }

    fixed = raw / "more"
    fixed.mkdir()
    (fixed / "batch_0002__2025-01-01__2025-01-01.json").write_text(
        json.dumps([_location(["2025-01-01"], 50.0)])
    )
    run()
    table = snapshots.read(spark, root)
    assert table.count() == 6
    assert {r["precipitation_sum"] for r in table.where("location_id = 3").collect()} == {3.0, 50.0}


def _run(spark, raw, numbered, batch_size=2, **options):
    root, checkpoint, quarantine, manifest = (scratch_path(spark, n) for n in "tcqm")

    def run():
        ingest.ingest(
            spark, str(raw), root, quarantine, checkpoint, numbered, batch_size, manifest, **options
        )
        bad = spark.read.option("basePath", quarantine).parquet(quarantine).collect()
        reasons = {(os.path.basename(r["path"]), r["reason"], r["position"]) for r in bad}
        rows = snapshots.read(spark, root).select("location_id", F.col("date").cast("string")).collect()
        units = {r["work_id"][:10]: (r["status"], r["error"]) for r in workplan.read_manifest(spark, manifest).collect()}
        return {tuple(r) for r in rows}, reasons, units

    return run


def test_units_that_break_a_rule_are_kept_out_as_a_whole(spark, tmp_path):
    days, window = ["2025-01-01", "2025-01-02"], "2025-01-01__2025-01-02"
    ragged = _location(days, 1.0)
    ragged["daily"]["precipitation_sum"] = [1.0]
    late = _location(["2025-01-01", "2025-01-03"], 1.0)
    whole = _location(days, 1.0)
    envelope = lambda ids: {
        "batch_number": 9, "location_ids": ids, "locations": [whole] * 2
    }
    files = {
        f"batch_0001__{window}": [whole],
        f"batch_0002__{window}": [whole, ragged],
        f"batch_0003__{window}": [late, whole],
        f"batch_0004__{window}": envelope([7, 8]),
        f"batch_0005__{window}": envelope([7, 99]),
        f"batch_0006__{window}": envelope([7]),
        f"batch_0077__{window}": [whole, whole],
        f"batch_0006__2025-01-01__2025-01-01": [_location(days[:1], 1.0)] * 2,
    }
    for name, content in files.items():
        (tmp_path / f"{name}.json").write_text(json.dumps(content))
    numbered = workplan.number_places(places(spark, 12), 2)
    rows, reasons, units = _run(spark, tmp_path, numbered)()
    assert rows == {(i, d) for i in (7, 8) for d in days} | {(11, days[0]), (12, days[0])}
    assert reasons == {
        (f"batch_0001__{window}.json", "location_count", 0),
        (f"batch_0002__{window}.json", "length_precipitation_sum", 2),
        (f"batch_0003__{window}.json", "last_date", 1),
        (f"batch_0005__{window}.json", "unknown_id", 2),
        (f"batch_0006__{window}.json", "location_count", 0),
        (f"batch_0077__{window}.json", "unknown_batch", 0),
    }
    assert units["batch_0004"] == ("success", None) and units["batch_0002"] == ("failed", "length_precipitation_sum")


def test_a_late_file_with_an_old_time_stamp_is_read(spark, tmp_path):
    numbered = workplan.number_places(places(spark, 3), 1)
    run = _run(spark, tmp_path, numbered, 1)

    def drop(batch, age_days):
        path = tmp_path / f"batch_{batch:04d}__2025-01-01__2025-01-01.json"
        path.write_text(json.dumps(_location(["2025-01-01"], 1.0)))
        then = path.stat().st_mtime - age_days * 86_400
        os.utime(path, (then, then))

    drop(1, 0)
    assert {r[0] for r in run()[0]} == {1}
    drop(2, 400)
    drop(3, 0)
    assert {r[0] for r in run()[0]} == {1, 2, 3}


def test_a_null_that_moves_is_a_change(spark):
    left = daily(spark, [row(1, START, temperature_max=5.0, temperature_min=None)])
    right = daily(spark, [row(1, START, temperature_max=None, temperature_min=5.0)])
    assert not same_content(left, right)
    root = scratch_path(spark, "t")
    snapshots.rebuild(spark, left, root)
    assert refresh.publish(spark, right, root) is True
    assert same_content(snapshots.read(spark, root), right)


def test_only_touched_months_are_rewritten(spark):
    root = _stored(spark, grid(3, 40))
    files = lambda: {
        (m, r["path"]) for m in (12, 1, 2) for r in snapshots.files(spark, root).where(f"month = {m}").collect()
    }
    before = files()
    new = daily(spark, grid(3, 1, START + timedelta(days=10), elevation=9.0))
    ingest.merge_batch(new.withColumn("file_time", F.current_timestamp()), root, 1)
    assert {m for m, _ in before ^ files()} == {1}
    table = snapshots.read(spark, root)
    assert table.count() == 120 and table.where("elevation = 9").count() == 3


def test_an_empty_table_fetches_from_the_first_day(spark):
    root, state = scratch_path(spark, "t"), scratch_path(spark, "s")
    snapshots.rebuild(spark, daily(spark, grid(2, 1)).where("false"), root)
    calls = []

    def fetch(start, end):
        calls.append((start, end))
        return daily(spark, grid(2, 9))

    with pytest.raises(ValueError, match="since"):
        refresh.refresh(spark, root, state, AS_OF, fetch, 2)
    outcome = refresh.refresh(spark, root, state, AS_OF, fetch, 2, since=START)
    assert outcome.status == "updated" and calls == [(START, AS_OF - timedelta(days=1))]
    assert snapshots.read(spark, root).count() == 18


def test_a_table_that_cannot_be_read_is_no_empty_table(spark, tmp_path):
    (tmp_path / "CURRENT").write_text("no pointer")
    new = daily(spark, grid(1, 1)).withColumn("file_time", F.current_timestamp())
    with pytest.raises(ValueError):
        ingest.merge_batch(new, str(tmp_path), 1)
    assert (tmp_path / "CURRENT").read_text() == "no pointer"


def test_file_listing_reads_no_contents(spark, tmp_path):
    (tmp_path / "batch_0012__2024-01-01__2024-01-14.json").write_text("{}")
    got = payloads.list_files(spark, str(tmp_path)).first()
    assert (got["batch_number"], got["start_date"], got["end_date"]) == (12, date(2024, 1, 1), date(2024, 1, 14))


def test_compaction_keeps_rows_and_follows_size(spark):
    root, target = scratch_path(spark, "table"), scratch_path(spark, "compact")
    rows = daily(spark, grid(5, 40))
    tables.rebuild_daily(rows, root)
    assert tables.compact(spark, root, target) == 1
    assert same_content(spark.read.parquet(target), rows)
    many = scratch_path(spark, "compact")
    assert tables.compact(spark, root, many, target_file_bytes=2000) > 1
    assert same_content(spark.read.parquet(many), rows)


def test_compaction_bounds_the_rows_of_a_file(spark):
    root, target = scratch_path(spark, "table"), scratch_path(spark, "compact")
    rows = daily(spark, grid(5, 40))
    tables.rebuild_daily(rows, root)
    assert tables.compact(spark, root, target, file_rows=50) == 4
    got = spark.read.parquet(target)
    assert same_content(got, rows)
    held = [r["count"] for r in got.groupBy(F.input_file_name()).count().collect()]
    assert len(held) > 2 and max(held) <= 100


def test_a_stream_numbers_its_catalogue_once_and_lists_in_few_tasks(spark, tmp_path, monkeypatch):
    raw = tmp_path / "raw"
    raw.mkdir()
    for batch in (1, 2, 3):
        (raw / f"batch_{batch:04d}__2025-12-28__2025-12-29.json").write_text("{broken")
    looked, seen = spark.sparkContext.accumulator(0), []

    @F.udf("long")
    def counted(i):
        looked.add(1)
        return i

    numbered = workplan.number_places(places(spark, 3), 1).withColumn(
        "population", counted.asNondeterministic()(F.col("location_id")).cast("double")
    )
    name = "spark.sql.sources.parallelPartitionDiscovery.parallelism"
    before, run = spark.conf.get(name), ingest.run_available

    def running(*args):
        seen.append(int(spark.conf.get(name)))
        return run(*args)

    monkeypatch.setattr(ingest, "run_available", running)
    paths = [str(tmp_path / n) for n in ("table", "quarantine", "checkpoint")]
    ingest.ingest(spark, str(raw), *paths, numbered, 1, max_files=1)
    assert looked.value == 3 and spark.conf.get(name) == before
    assert seen == [min(int(before), ingest.LISTING_TASKS * spark.sparkContext.defaultParallelism)]
    assert spark.read.parquet(paths[1]).count() == 3
