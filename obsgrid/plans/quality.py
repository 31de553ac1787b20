"""Quality rules over the daily table and its profiles, some with planted defects."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from obsgrid.operators import quality as rules
from obsgrid.plans.observations import HOLES_SQL, _with_holes
from obsgrid.plans.profiles import (
    FEATURES,
    FEATURES_SQL,
    PROFILE_SQL,
    assignment_rules,
    climate,
    profile,
)
from obsgrid.plans.registry import ORACLES, query
from obsgrid.schema import MEASURE_NAMES
from obsgrid.session import scratch_path
from obsgrid.sources.tables import write_report
from obsgrid.sources.views import DAILY_SQL, catalogue, daily_obs, readings



def _copied(daily: DataFrame) -> DataFrame:
    """The table with the rows of wet days doubled and those of very wet days tripled."""
    copies = F.when(F.col("precipitation_sum") > 80, 3).when(F.col("precipitation_sum") > 45, 2).otherwise(1)
    return daily.select("*", F.explode(F.sequence(F.lit(1), copies)).alias("copy")).drop("copy")


COPIED_SQL = f"""{DAILY_SQL}, copied AS (
  SELECT d.* FROM daily_obs d, UNNEST(range(0, CASE WHEN precipitation_sum > 80 THEN 3
    WHEN precipitation_sum > 45 THEN 2 ELSE 1 END)) AS t(i))"""


@query(f"""WITH {COPIED_SQL}
SELECT COUNT(*) - COUNT(DISTINCT (location_id, date)) AS extra_rows FROM copied""")
def dup_extra_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rules.duplicate_extra_rows(_copied(readings(spark, sf_dir)))


@query(f"""WITH {COPIED_SQL}
SELECT location_id, date, COUNT(*) AS copies FROM copied GROUP BY 1, 2 HAVING COUNT(*) > 1""")
def dup_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rules.duplicate_groups(_copied(readings(spark, sf_dir)))


def _disordered(daily: DataFrame) -> DataFrame:
    """Some minima and means pushed out of order."""
    return daily.withColumns(
        {
            "temperature_min": F.when(
                F.col("precipitation_sum") == 10, F.col("temperature_mean") + 1
            ).otherwise(F.col("temperature_min")),
            "temperature_max": F.when(
                F.col("precipitation_sum") == 20, F.col("temperature_mean") - 1
            ).otherwise(F.col("temperature_max")),
        }
    )


@query(f"""WITH {DAILY_SQL}, broken AS (
  SELECT temperature_mean,
    CASE WHEN precipitation_sum = 10 THEN temperature_mean + 1 ELSE temperature_min END AS temperature_min,
    CASE WHEN precipitation_sum = 20 THEN temperature_mean - 1 ELSE temperature_max END AS temperature_max
  FROM daily_obs)
SELECT COUNT(*) FILTER (WHERE temperature_min > temperature_mean OR temperature_mean > temperature_max)
    AS violations,
  COUNT(*) FILTER (WHERE temperature_min > temperature_mean) AS min_above_mean,
  COUNT(*) FILTER (WHERE temperature_mean > temperature_max) AS mean_above_max,
  COUNT(*) FILTER (WHERE temperature_min > temperature_max) AS min_above_max FROM broken""")
def range_consistency(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rules.range_consistency(_disordered(readings(spark, sf_dir)))


SPOILT = ("temperature_mean", "precipitation_sum", "wind_speed_mean")


@query(f"""WITH {DAILY_SQL}
SELECT 'temperature_mean' AS column_name, COUNT(*) FILTER (WHERE precipitation_sum = 7) AS nonfinite FROM daily_obs
UNION ALL SELECT 'precipitation_sum', 0 FROM daily_obs HAVING COUNT(*) > 0
UNION ALL SELECT 'wind_speed_mean', COUNT(*) FILTER (WHERE wind_speed_mean = 0) FROM daily_obs""")
def nonfinite(spark: SparkSession, sf_dir: str) -> DataFrame:
    """NaN and infinities planted in two columns."""
    spoilt = readings(spark, sf_dir).withColumns(
        {
            "temperature_mean": F.when(F.col("precipitation_sum") == 7, F.lit(float("nan"))).otherwise(
                F.col("temperature_mean")
            ),
            "wind_speed_mean": F.when(F.col("wind_speed_mean") == 0, F.lit(float("-inf"))).otherwise(
                F.col("wind_speed_mean")
            ),
        }
    )
    return rules.nonfinite_counts(spoilt, SPOILT)


@query(f"""WITH {PROFILE_SQL}
SELECT location_id, city, daily_observation_count,
  (SELECT CAST(MAX(date) - MIN(date) + 1 AS BIGINT) FROM daily_obs) AS expected FROM profile
WHERE daily_observation_count <> (SELECT MAX(date) - MIN(date) + 1 FROM daily_obs)""")
def count_offenders(spark: SparkSession, sf_dir: str) -> DataFrame:
    span = (
        readings(spark, sf_dir)
        .agg((F.datediff(F.max("date"), F.min("date")) + 1).cast("long").alias("days"))
        .scalar()
    )
    places = profile(spark, sf_dir).select("location_id", "city", "daily_observation_count")
    return rules.count_offenders(places, "daily_observation_count", span)


@query(f"""WITH {DAILY_SQL}, b AS (SELECT MIN(date) AS first, MAX(date) AS last FROM daily_obs),
per AS (SELECT location_id, COUNT(*) AS rows, COUNT(DISTINCT date) AS days FROM daily_obs GROUP BY location_id)
SELECT location_id, rows, days, CAST(last - first + 1 AS BIGINT) AS expected_days,
  rows = last - first + 1 AND days = last - first + 1 AS complete FROM per, b""")
def date_continuity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rules.continuity(readings(spark, sf_dir))


GAPS_SQL = f"""{DAILY_SQL}, b AS (SELECT MIN(date) AS first, MAX(date) AS last FROM daily_obs),
steps AS (
  SELECT location_id, date, LEAD(date) OVER (PARTITION BY location_id ORDER BY date) AS following,
    LAG(date) OVER (PARTITION BY location_id ORDER BY date) AS previous, first, last FROM daily_obs, b),
gaps AS (
  SELECT location_id, CAST(date + 1 AS DATE) AS gap_start, CAST(COALESCE(following - 1, last) AS DATE) AS gap_end FROM steps
  UNION ALL SELECT location_id, first, CAST(date - 1 AS DATE) FROM steps WHERE previous IS NULL)"""


@query(f"""WITH {GAPS_SQL} SELECT location_id, gap_start, gap_end,
  CAST(gap_end - gap_start + 1 AS INTEGER) AS missing_days FROM gaps WHERE gap_start <= gap_end""")
def date_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rules.date_gaps(readings(spark, sf_dir))


@query(f"""WITH {DAILY_SQL}, b AS (SELECT MIN(date) AS first, MAX(date) AS last FROM daily_obs),
calendar AS (SELECT CAST(UNNEST(generate_series(first, last, INTERVAL 1 DAY)) AS DATE) AS date FROM b)
SELECT l.location_id, c.date FROM (SELECT DISTINCT location_id FROM daily_obs) l, calendar c
WHERE NOT EXISTS (SELECT 1 FROM daily_obs d WHERE d.location_id = l.location_id AND d.date = c.date)""")
def missing_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rules.missing_dates(rules.date_gaps(readings(spark, sf_dir)))


@query(f"""WITH {HOLES_SQL},
{FEATURES_SQL[len(DAILY_SQL) + 2:]},
per AS (SELECT location_id, COUNT(*) AS n, COUNT(DISTINCT date) AS days FROM holes GROUP BY location_id),
facts AS (
  SELECT COUNT(*) AS rows, COUNT(DISTINCT location_id) AS locations, COUNT(DISTINCT city) AS cities,
    MIN(date) AS first, MAX(date) AS last, CAST(MAX(date) - MIN(date) + 1 AS BIGINT) AS span,
    SUM({' + '.join(f'CAST({m} IS NULL AS INTEGER)' for m in MEASURE_NAMES)}) AS missing,
    (SELECT COUNT(*) FROM catalogue) AS wanted, (SELECT MIN(n) FROM per) AS fewest,
    (SELECT MAX(n) FROM per) AS most, (SELECT MIN(days) FROM per) AS fewest_days FROM holes),
rules AS (
  SELECT 'daily' AS dataset, 'rows' AS rule, CAST(rows AS VARCHAR) AS observed,
    CAST(wanted * span AS VARCHAR) AS expected FROM facts
  UNION ALL SELECT 'daily', 'locations', CAST(locations AS VARCHAR), CAST(wanted AS VARCHAR) FROM facts
  UNION ALL SELECT 'daily', 'cities', CAST(cities AS VARCHAR), CAST(wanted AS VARCHAR) FROM facts
  UNION ALL SELECT 'daily', 'duplicates', '0', '0' FROM facts
  UNION ALL SELECT 'daily', 'missing_values', CAST(missing AS VARCHAR), '0' FROM facts
  UNION ALL SELECT 'daily', 'temperature_consistency', '0', '0' FROM facts
  UNION ALL SELECT 'daily', 'fewest_rows_per_location', CAST(fewest AS VARCHAR), CAST(span AS VARCHAR) FROM facts
  UNION ALL SELECT 'daily', 'most_rows_per_location', CAST(most AS VARCHAR), CAST(span AS VARCHAR) FROM facts
  UNION ALL SELECT 'daily', 'fewest_days_per_location', CAST(fewest_days AS VARCHAR), CAST(span AS VARCHAR) FROM facts
  UNION ALL SELECT 'daily', 'minimum_date', CAST(first AS VARCHAR), '1995-01-02' FROM facts
  UNION ALL SELECT 'daily', 'maximum_date', CAST(last AS VARCHAR), '2001-11-30' FROM facts
  UNION ALL SELECT 'features', 'duplicate_ids', CAST(COUNT(*) - COUNT(DISTINCT location_id) AS VARCHAR), '0' FROM features
  UNION ALL SELECT 'features', 'missing_values',
    CAST(SUM({' + '.join(f'CAST({c} IS NULL AS INTEGER)' for c in FEATURES)}) AS VARCHAR), '0' FROM features)
SELECT *, CASE WHEN observed = expected THEN 'PASS' ELSE 'FAIL' END AS status FROM rules""")
def dq_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily and feature reports together, the daily table having holes."""
    places = catalogue(spark, sf_dir).agg(F.count(F.lit(1)).alias("n")).scalar()
    daily = rules.daily_report(
        _with_holes(daily_obs(spark, sf_dir)), "daily", places, "1995-01-02", "2001-11-30"
    )
    return daily.unionByName(rules.feature_report(climate(spark, sf_dir), "features", FEATURES))


@query(f"""SELECT *, 'test tables' AS source FROM ({ORACLES['dq_report']})
UNION ALL SELECT *, 'assignment by id' AS source FROM ({ORACLES['assignment_rules']})""")
def report_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The reports of all datasets with where they come from, written as JSON and read back."""
    found = dq_report(spark, sf_dir).withColumn("source", F.lit("test tables")).unionByName(
        assignment_rules(spark, sf_dir).withColumn("source", F.lit("assignment by id"))
    )
    path = scratch_path(spark, "report")
    write_report(found, path, "json")
    return spark.read.schema(found.schema).json(path)


# Readings as whole numbers of grid steps, as text that every engine writes alike: as they are, and
# some of them missing, so that the marks of NULLs are digested too.
DIGEST_COLUMNS = sorted(["location_id", "date", *MEASURE_NAMES])


def _steps(daily: DataFrame) -> DataFrame:
    return daily.select(
        "location_id",
        F.col("date").cast("string").alias("date"),
        *[(F.col(m) * 65536).cast("long").alias(m) for m in MEASURE_NAMES],
    )


def _missing(steps: DataFrame) -> DataFrame:
    """Each measure missing at the places whose id its number divides."""
    return steps.withColumns(
        {m: F.when(F.col("location_id") % (i + 5) != 0, F.col(m)) for i, m in enumerate(MEASURE_NAMES)}
    )


def _digest_sql(table: str) -> str:
    cells = " || '|' || ".join(f"COALESCE('=' || CAST({c} AS VARCHAR), '~')" for c in DIGEST_COLUMNS)
    return f"""SELECT '{table}' AS dataset, COUNT(*) AS rows, CAST(SUM(h) AS VARCHAR) AS hash_sum, BIT_XOR(h) AS hash_xor
FROM (SELECT CAST('0x' || SUBSTR(md5({cells}), 1, 15) AS BIGINT) AS h FROM {table})"""


@query(f"""WITH {DAILY_SQL}, steps AS (SELECT location_id, CAST(date AS VARCHAR) AS date,
  {', '.join(f'CAST({m} * 65536 AS BIGINT) AS {m}' for m in MEASURE_NAMES)}
  FROM readings),
missing AS (SELECT location_id, date,
  {', '.join(f'CASE WHEN location_id % {i + 5} <> 0 THEN {m} END AS {m}' for i, m in enumerate(MEASURE_NAMES))}
  FROM steps)
{_digest_sql('steps')}
UNION ALL {_digest_sql('missing')}""")
def fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests of the readings, as they are and with missing values, by a hash that SQL can repeat."""
    steps = _steps(readings(spark, sf_dir))
    found = [
        rules.fingerprint(table, row_hash=rules.text_hash).select(F.lit(name).alias("dataset"), "*")
        for name, table in (("steps", steps), ("missing", _missing(steps)))
    ]
    return found[0].union(found[1]).withColumn("hash_sum", F.col("hash_sum").cast("string"))
