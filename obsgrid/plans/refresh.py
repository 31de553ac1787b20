"""Queries of the incremental layer: plans, resume, upserts, gates, publishing, streams."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from obsgrid.operators.quality import fast_hash
from obsgrid.plans import landing
from obsgrid.plans.landing import BATCH, DAYS, FAULTS_SQL, PLAN_SQL
from obsgrid.plans.registry import query
from obsgrid.schema import DAILY_SCHEMA, MEASURE_NAMES
from obsgrid.session import scratch_path
from obsgrid.sources import payloads, snapshots, tables
from obsgrid.sources.views import DAILY_COLUMNS, DAILY_SQL, catalogue, daily_obs, readings
from obsgrid.streaming import ingest, refresh, workplan

DAILY_LIST = ", ".join(DAILY_COLUMNS)
NAMES = DAILY_SCHEMA.fieldNames()
OVERLAP = date(2000, 12, 20)
END_OF_BASE = date(2001, 1, 1)


def _plan(spark: SparkSession, sf_dir: str) -> DataFrame:
    span = landing.bounds(spark, sf_dir)
    numbered = landing.numbered(spark, sf_dir)
    return workplan.work_plan(numbered, span["min_date"], span["max_date"], DAYS)


@query(f"WITH {PLAN_SQL} SELECT batch_number, locations, start_date, end_date, work_id, days FROM plan")
def work_plan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _plan(spark, sf_dir)


# Every fifth unit failed, every fifth was never tried, the rest succeeded.
MANIFEST_SQL = f"""{PLAN_SQL}, turns AS (
  SELECT *, (batch_number * 3 + days + CAST(EXTRACT(DAY FROM start_date) AS INTEGER)) % 5 AS turn FROM plan),
manifest AS (SELECT work_id, CASE WHEN turn = 0 THEN 'failed' ELSE 'success' END AS status
  FROM turns WHERE turn <> 1),
files AS (SELECT work_id, batch_number % 3 <> 0 AS valid FROM plan
  WHERE (batch_number + CAST(EXTRACT(DAY FROM start_date) AS INTEGER)) % 4 <> 0)"""


def _manifest(plan: DataFrame) -> DataFrame:
    turn = (F.col("batch_number") * 3 + F.col("days") + F.dayofmonth("start_date")) % 5
    status = F.when(turn == 0, "failed").otherwise("success")
    return plan.where(turn != 1).select("work_id", status.alias("status"))


def _files(plan: DataFrame) -> DataFrame:
    present = (F.col("batch_number") + F.dayofmonth("start_date")) % 4 != 0
    return plan.where(present).select("work_id", (F.col("batch_number") % 3 != 0).alias("valid"))


@query(f"""WITH {MANIFEST_SQL} SELECT work_id FROM plan
WHERE work_id NOT IN (SELECT work_id FROM manifest WHERE status = 'success')""")
def pending_units(spark: SparkSession, sf_dir: str) -> DataFrame:
    plan = _plan(spark, sf_dir)
    return workplan.pending_units(plan, _manifest(plan)).select("work_id")


@query(f"""WITH {MANIFEST_SQL} SELECT COUNT(*) AS total, COUNT(*) FILTER (WHERE status = 'success') AS success,
  COUNT(*) FILTER (WHERE status = 'failed') AS failed FROM manifest""")
def manifest_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return workplan.manifest_summary(_manifest(_plan(spark, sf_dir)))


@query(f"""WITH {MANIFEST_SQL}, done AS (SELECT work_id FROM manifest WHERE status = 'success')
SELECT p.work_id, CASE WHEN d.work_id IS NOT NULL AND f.work_id IS NOT NULL THEN 'skip'
  WHEN d.work_id IS NOT NULL THEN 'refetch' WHEN f.work_id IS NOT NULL AND f.valid THEN 'adopt'
  WHEN f.work_id IS NOT NULL THEN 'replace' ELSE 'fetch' END AS action
FROM plan p LEFT JOIN done d ON p.work_id = d.work_id LEFT JOIN files f ON p.work_id = f.work_id""")
def resume_actions(spark: SparkSession, sf_dir: str) -> DataFrame:
    plan = _plan(spark, sf_dir)
    return workplan.resume_actions(plan, _manifest(plan), _files(plan))


@query(f"""WITH {MANIFEST_SQL}, done AS (SELECT work_id FROM manifest WHERE status = 'success')
SELECT COUNT(*) AS files, COUNT(d.work_id) AS converted, COUNT(*) - COUNT(d.work_id) AS pending
FROM plan p LEFT JOIN done d ON p.work_id = d.work_id""")
def backlog(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The real file listing of the landing folder against the manifest."""
    files = payloads.list_files(spark, landing.array_files(spark, sf_dir))
    return workplan.backlog(files, _manifest(_plan(spark, sf_dir)))


@query(f"""WITH {FAULTS_SQL},
tried AS (SELECT work_id, (batch_number * 3 + days + CAST(EXTRACT(DAY FROM start_date) AS INTEGER)) % 5 AS t FROM plan),
records AS (SELECT work_id, CASE WHEN t = 0 THEN 'failed' ELSE 'success' END AS status FROM tried WHERE t < 2),
acts AS (
  SELECT p.work_id, m.status, CASE WHEN m.status = 'success' AND u.work_id IS NOT NULL THEN 'skip'
    WHEN m.status = 'success' THEN 'refetch' WHEN u.work_id IS NOT NULL AND u.reason IS NULL THEN 'adopt'
    WHEN u.work_id IS NOT NULL THEN 'replace' ELSE 'fetch' END AS action
  FROM plan p LEFT JOIN records m ON p.work_id = m.work_id LEFT JOIN units u ON p.work_id = u.work_id)
SELECT work_id, action, CASE WHEN action = 'adopt' THEN 'success' ELSE status END AS recorded,
  action IN ('skip', 'adopt') AS present FROM acts""")
def resume_landed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A folder of landed files, some of them broken, against a manifest of some of the units:
    sound files are adopted, broken ones deleted, and both can be seen afterwards."""
    raw, manifest = scratch_path(spark, "raw"), scratch_path(spark, "manifest")
    landing.write_texts(landing.faulty_texts(spark, sf_dir), raw)
    plan = _plan(spark, sf_dir)
    turn = (F.col("batch_number") * 3 + F.col("days") + F.dayofmonth("start_date")) % 5
    status = F.when(turn == 0, "failed").otherwise("success").alias("status")
    started = plan.where(turn < 2).select("work_id", status, F.lit(None).cast("string").alias("error"))
    workplan.record_units(started, manifest)
    numbered = landing.numbered(spark, sf_dir)
    actions = ingest.resume(spark, raw, plan, numbered, manifest, full_windows=False)
    recorded = workplan.read_manifest(spark, manifest).select("work_id", F.col("status").alias("recorded"))
    left = payloads.list_files(spark, raw).select("work_id", F.lit(True).alias("there")).distinct()
    return (
        actions.join(recorded, "work_id", "left")
        .join(left, "work_id", "left")
        .select("work_id", "action", "recorded", F.col("there").isNotNull().alias("present"))
    )


# ---- freshness and merging -------------------------------------------------------------


@query(f"""WITH {DAILY_SQL} SELECT location_id, date, {', '.join(MEASURE_NAMES)}, year FROM readings
WHERE date <= DATE '2001-05-31'""")
def complete_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    return refresh.complete_days(readings(spark, sf_dir), date(2001, 6, 1))


@query(f"""WITH {DAILY_SQL}, m AS (SELECT MAX(date) AS d FROM readings)
SELECT d AS stored_until, CAST(d + 1 AS DATE) AS start_date, DATE '2001-11-30' AS end_date,
  CAST(GREATEST(DATE '2001-11-30' - d, 0) AS INTEGER) AS days FROM m""")
def missing_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    return refresh.missing_range(readings(spark, sf_dir), date(2001, 12, 1))


@query(f"""WITH {DAILY_SQL}, m AS (SELECT location_id, MAX(date) AS d FROM readings GROUP BY location_id)
SELECT location_id, d AS stored_until, CAST(d + 1 AS DATE) AS start_date, DATE '2001-10-31' AS end_date,
  CAST(DATE '2001-10-31' - d AS INTEGER) AS days FROM m WHERE d < DATE '2001-10-31'""")
def missing_range_per_location(spark: SparkSession, sf_dir: str) -> DataFrame:
    return refresh.missing_range_per_location(readings(spark, sf_dir), date(2001, 11, 1))


def _base(daily: DataFrame) -> DataFrame:
    return daily.where(F.col("date") < F.lit(END_OF_BASE))


def _corrected(daily: DataFrame) -> DataFrame:
    """New rows; those that overlap the base carry another rain value."""
    return daily.where(F.col("date") >= F.lit(OVERLAP)).withColumn(
        "precipitation_sum", F.col("precipitation_sum") + 1000
    )


def _merged_sql(columns: str = DAILY_LIST) -> str:
    return f"""WITH {DAILY_SQL}, merged AS (SELECT * REPLACE (
  CASE WHEN date >= DATE '{OVERLAP}' THEN precipitation_sum + 1000 ELSE precipitation_sum END
    AS precipitation_sum) FROM daily_obs)
SELECT {columns} FROM merged"""


@query(_merged_sql())
def upsert_keep_last(spark: SparkSession, sf_dir: str) -> DataFrame:
    daily = daily_obs(spark, sf_dir)
    merged = refresh.upsert(refresh.ranked(_base(daily), 0), refresh.ranked(_corrected(daily), 1))
    return merged.select(*NAMES)


@query(_merged_sql())
def refresh_publish(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base table on disk, new rows merged into the months they touch, published, read back."""
    daily = daily_obs(spark, sf_dir)
    root, staging = scratch_path(spark, "table"), scratch_path(spark, "staged")
    snapshots.rebuild(spark, _base(daily), root)
    fresh = _corrected(daily)
    touched = snapshots.read(spark, root, tables.months_of(fresh))
    merged = refresh.upsert(refresh.ranked(touched, 0), refresh.ranked(fresh, 1))
    merged.select(*NAMES).write.parquet(staging)
    refresh.publish(spark, spark.read.schema(DAILY_SCHEMA).parquet(staging), root)
    return snapshots.read(spark, root)


def _in_parts(spark: SparkSession, sf_dir: str, root: str) -> None:
    """The daily table merged in three batches, by place, the last with the true values of the
    first."""
    daily = daily_obs(spark, sf_dir, F.trunc("date", "month"))
    turn = F.col("location_id") % 2
    wrong = daily.where(turn == 0).withColumn("precipitation_sum", F.lit(-1.0))
    for batch, rows in enumerate((wrong, daily.where(turn == 1), daily.where(turn == 0))):
        ranked = rows.withColumn("batch_id", F.lit(batch).cast("long"))
        snapshots.merge(spark, ranked, root, buckets=2)


@query(f"WITH {DAILY_SQL} SELECT {DAILY_LIST} FROM daily_obs")
def snapshot_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Batches merged into the files that may hold their keys; small files joined afterwards."""
    root = scratch_path(spark, "table")
    _in_parts(spark, sf_dir, root)
    snapshots.compact(spark, root, tables.TARGET_FILE_BYTES)
    snapshots.expire(spark, root)
    return snapshots.read(spark, root)


@query(f"""WITH {DAILY_SQL} SELECT year, CAST(EXTRACT(MONTH FROM date) AS INTEGER) AS month, COUNT(*) AS rows,
  TRUE AS recounted FROM daily_obs GROUP BY ALL""")
def digest_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests of the months by the table's file list, held against a count of the rows."""
    root = scratch_path(spark, "table")
    _in_parts(spark, sf_dir, root)
    listed = snapshots.digest(spark, root, "year", "month")
    hashed = daily_obs(spark, sf_dir).select(
        "year", F.month("date").alias("month"), fast_hash(sorted(NAMES)).alias("h")
    )
    counted = hashed.groupBy("year", "month").agg(
        F.count(F.lit(1)).alias("_rows"),
        F.sum(F.col("h").cast("decimal(38,0)")).cast("decimal(38,0)").alias("_sum"),
        F.bit_xor("h").alias("_xor"),
    )
    same = (F.col("rows") == F.col("_rows")) & (F.col("hash_sum") == F.col("_sum"))
    return listed.join(counted, ["year", "month"], "full").select(
        "year", "month", "rows", F.coalesce(same & (F.col("hash_xor") == F.col("_xor")), F.lit(False)).alias("recounted")
    )


def _full_grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every place on every day: the readings, and constant values where there are none."""
    span = landing.bounds(spark, sf_dir)
    calendar = (
        catalogue(spark, sf_dir)
        .withColumn("_b", span)
        .withColumnsRenamed({"latitude": "source_latitude", "longitude": "source_longitude"})
        .select("*", F.explode(F.sequence("_b.min_date", "_b.max_date")).alias("date"))
        .drop("_b", "population")
    )
    constants = dict(zip(MEASURE_NAMES, (25.0, 30.0, 20.0, 1.0, 70.0, 10.0, 1000.0), strict=True))
    found = readings(spark, sf_dir).drop("year")
    return (
        calendar.join(found, ["location_id", "date"], "left")
        .withColumns({m: F.coalesce(m, F.lit(v)) for m, v in constants.items()})
        .withColumns(
            {
                "model_latitude": F.col("source_latitude") + 0.125,
                "model_longitude": F.col("source_longitude") - 0.125,
                "timezone": F.concat(F.lit("Zone/"), "iso3"),
                "elevation": ((F.col("location_id") * 29) % 3000).cast("double"),
                "year": F.year("date"),
            }
        )
        .select(*NAMES)
    )


GRID_SQL = f"""{DAILY_SQL}, b AS (SELECT MIN(date) AS first, MAX(date) AS last FROM readings),
calendar AS (SELECT CAST(UNNEST(generate_series(first, last, INTERVAL 1 DAY)) AS DATE) AS date FROM b),
grid AS (
  SELECT c.location_id, d.date, CAST(EXTRACT(YEAR FROM d.date) AS INTEGER) AS year,
    COALESCE(r.temperature_mean, 25.0::DOUBLE) AS temperature_mean,
    COALESCE(r.precipitation_sum, 1.0::DOUBLE) AS precipitation_sum
  FROM catalogue c CROSS JOIN calendar d
  LEFT JOIN readings r ON r.location_id = c.location_id AND r.date = d.date)"""


def _stored_grid(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, int]:
    path = scratch_path(spark, "grid")
    _full_grid(spark, sf_dir).write.parquet(path)
    grid = spark.read.schema(DAILY_SCHEMA).parquet(path)
    return grid, catalogue(spark, sf_dir).count()


def _between(grid: DataFrame):
    return lambda start, end: grid.where(F.col("date").between(F.lit(start), F.lit(end)))


def _yearly(df: DataFrame) -> DataFrame:
    return df.groupBy("year").agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_distinct("location_id").alias("locations"),
        F.sum("temperature_mean").alias("temperature"),
        F.sum("precipitation_sum").alias("precipitation"),
        F.max("date").alias("last_date"),
    )


@query(f"""WITH {GRID_SQL}
SELECT year, COUNT(*) AS rows, COUNT(DISTINCT location_id) AS locations, SUM(temperature_mean) AS temperature,
  SUM(precipitation_sum) AS precipitation, MAX(date) AS last_date FROM grid GROUP BY year""")
def refresh_catchup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table that missed days across a year's end catches up in one run; a second run and a
    run with bad data change nothing."""
    grid, places = _stored_grid(spark, sf_dir)
    root, state = scratch_path(spark, "table"), scratch_path(spark, "state")
    snapshots.rebuild(spark, grid.where(F.col("date") < "2000-12-28"), root)
    fetch = _between(grid)
    bad = refresh.refresh(
        spark, root, state, date(2001, 1, 2),
        lambda a, b: fetch(a, b).withColumn("temperature_mean", F.lit(-99.0)), places,
    )
    if bad.status != "rejected":
        raise AssertionError(f"a broken batch was published: {bad}")
    latest = grid.agg(F.date_add(F.max("date"), 1).alias("d")).first()["d"]
    for expected in ("updated", "current"):
        outcome = refresh.refresh(spark, root, state, latest, fetch, places)
        if outcome.status != expected:
            raise AssertionError(f"expected {expected}: {outcome}")
    return _yearly(snapshots.read(spark, root))


@query(f"""WITH {DAILY_SQL} SELECT 'current' AS status, MAX(date) AS last_successful_date, COUNT(*) AS rows
FROM daily_obs""")
def refresh_noop(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nothing new: no fetch, the table untouched, the state saved again."""
    root, state = scratch_path(spark, "table"), scratch_path(spark, "state")
    snapshots.rebuild(spark, daily_obs(spark, sf_dir), root)
    table = snapshots.read(spark, root)

    def no_fetch(start: date, end: date) -> DataFrame:
        raise AssertionError("nothing is missing, so nothing may be fetched")

    as_of = table.agg(F.date_add(F.max("date"), 1).alias("d")).first()["d"]
    outcome = refresh.refresh(spark, root, state, as_of, no_fetch, 0)
    saved = refresh.read_state(spark, state)
    return table.agg(F.count(F.lit(1)).alias("rows")).select(
        F.lit(outcome.status).alias("status"), F.lit(saved).alias("last_successful_date"), "rows"
    )


@query(f"""WITH {DAILY_SQL},
facts AS (SELECT (SELECT COUNT(*) FROM readings WHERE date >= DATE '{OVERLAP}') AS fresh, COUNT(*) AS rows,
  (SELECT COUNT(*) FROM catalogue) AS places, CAST(MAX(date) - MIN(date) + 1 AS BIGINT) AS span FROM readings),
rules AS (
  SELECT 'refresh' AS dataset, 'new_rows' AS rule, CAST(fresh AS VARCHAR) AS observed,
    CAST(places * 319 AS VARCHAR) AS expected FROM facts
  UNION ALL SELECT 'refresh', 'total_rows', CAST(rows AS VARCHAR), CAST(places * span AS VARCHAR) FROM facts
  UNION ALL SELECT 'refresh', 'duplicates', '0', '0' FROM facts
  UNION ALL SELECT 'refresh', 'missing_values', '0', '0' FROM facts
  UNION ALL SELECT 'refresh', 'temperature_consistency', '0', '0' FROM facts)
SELECT *, CASE WHEN observed = expected THEN 'PASS' ELSE 'FAIL' END AS status FROM rules""")
def refresh_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The gate over an incomplete merge: row rules fail, value rules pass."""
    daily = daily_obs(spark, sf_dir)
    new = _corrected(daily)
    merged = refresh.upsert(refresh.ranked(_base(daily), 0), refresh.ranked(new, 1))
    places = catalogue(spark, sf_dir).agg(F.count(F.lit(1)).alias("n")).scalar()
    return refresh.gate(new, merged, places, 319)


# ---- streams ---------------------------------------------------------------------------


def _ingest(
    spark: SparkSession, sf_dir: str, raw: str, root: str, checkpoint: str
) -> tuple[str, str]:
    """Paths of the quarantine and of the manifest. The test tables leave days out."""
    quarantine, manifest = scratch_path(spark, "quarantine"), scratch_path(spark, "manifest")
    numbered = landing.numbered(spark, sf_dir)
    ingest.ingest(
        spark, raw, root, quarantine, checkpoint, numbered, BATCH, manifest, full_windows=False
    )
    return quarantine, manifest


def _ingest_faulty(spark: SparkSession, sf_dir: str) -> tuple[str, str]:
    raw, root, checkpoint = (scratch_path(spark, n) for n in ("raw", "table", "stream"))
    landing.write_texts(landing.faulty_texts(spark, sf_dir), raw)
    return _ingest(spark, sf_dir, raw, root, checkpoint)


@query(f"WITH {FAULTS_SQL} SELECT work_id, reason, position FROM units WHERE reason IS NOT NULL")
def ingest_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Units that break a rule, one row per rule."""
    quarantine, _ = _ingest_faulty(spark, sf_dir)
    refused = spark.read.option("basePath", quarantine).parquet(quarantine)
    return refused.select(
        payloads.file_meta(F.col("path"))["work_id"].alias("work_id"), "reason", "position"
    )


@query(f"""WITH {FAULTS_SQL} SELECT work_id,
  CASE WHEN reason IS NULL THEN 'success' ELSE 'failed' END AS status, reason AS error FROM units""")
def ingest_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The outcome of every unit."""
    _, manifest = _ingest_faulty(spark, sf_dir)
    return workplan.read_manifest(spark, manifest).select("work_id", "status", "error")


@query(f"WITH {DAILY_SQL} SELECT {DAILY_LIST} FROM daily_obs")
def stream_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Payload files streamed into the daily table."""
    root, checkpoint = scratch_path(spark, "table"), scratch_path(spark, "stream")
    _ingest(spark, sf_dir, landing.array_files(spark, sf_dir), root, checkpoint)
    return snapshots.read(spark, root)


@query(f"""WITH {DAILY_SQL} SELECT {', '.join('precipitation_sum + 1000 AS precipitation_sum'
  if c == 'precipitation_sum' else c for c in DAILY_COLUMNS)} FROM daily_obs""")
def stream_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Corrected files arrive later; a second run reads only them and they win every key."""
    raw, root, checkpoint = (scratch_path(spark, n) for n in ("raw", "table", "stream"))
    landing.write_texts(landing.corrections(spark, sf_dir, 0.0), raw)
    _ingest(spark, sf_dir, raw, root, checkpoint)
    landing.write_texts(landing.corrections(spark, sf_dir, 1000.0), raw, mode="append")
    _ingest(spark, sf_dir, raw, root, checkpoint)
    return snapshots.read(spark, root)
