"""Queries over raw payload files: metadata, flattening, joins and payload rules."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from obsgrid.operators import quality as rules
from obsgrid.plans import landing
from obsgrid.plans.landing import BATCH, PLAN_SQL
from obsgrid.plans.registry import query
from obsgrid.sources import payloads
from obsgrid.sources.views import DAILY_COLUMNS, DAILY_SQL, catalogue

DAILY_LIST = ", ".join(DAILY_COLUMNS)


@query(f"WITH {PLAN_SQL} SELECT work_id, batch_number, start_date, end_date FROM plan")
def filename_meta(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = payloads.list_files(spark, landing.array_files(spark, sf_dir))
    return files.select("work_id", "batch_number", "start_date", "end_date")


@query(f"WITH {DAILY_SQL} SELECT {DAILY_LIST} FROM daily_obs")
def explode_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw files to the daily table: the fold into payloads undone exactly."""
    raw = payloads.read_payloads(spark, landing.array_files(spark, sf_dir))
    return payloads.flatten_payloads(raw, landing.numbered(spark, sf_dir), BATCH)


@query(f"""WITH {PLAN_SQL}
SELECT n.batch_number, n.ordinal, n.location_id, n.city, COUNT(*) AS days,
  SUM(precipitation_sum) AS precipitation FROM numbered n
JOIN readings r ON n.location_id = r.location_id GROUP BY 1, 2, 3, 4""")
def positional_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Entry i of batch b is catalogue row (b - 1) * size + i."""
    places = landing.numbered(spark, sf_dir)
    raw = payloads.read_payloads(spark, landing.array_files(spark, sf_dir))
    days = payloads.flatten_payloads(raw, places, BATCH)
    per = days.groupBy("location_id", "city").agg(
        F.count(F.lit(1)).alias("days"), F.sum("precipitation_sum").alias("precipitation")
    )
    return per.join(places.select("location_id", "ordinal", "batch_number"), "location_id")


@query(f"""WITH {PLAN_SQL}, known AS (SELECT * FROM catalogue WHERE population > 0)
SELECT n.location_id, COUNT(k.location_id) > 0 AS known,
  COUNT(CASE WHEN k.location_id IS NOT NULL THEN r.date END) AS days
FROM numbered n JOIN readings r ON n.location_id = r.location_id
LEFT JOIN known k ON k.location_id = n.location_id GROUP BY n.location_id""")
def id_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Envelope ids against a catalogue that lacks some of them."""
    known = catalogue(spark, sf_dir).where(F.col("population") > 0)
    envelopes = payloads.parsed_once(payloads.read_envelopes(spark, landing.envelope_files(spark, sf_dir)))
    matched = payloads.flatten_envelopes(envelopes, known, strict=False).groupBy("location_id").agg(
        F.lit(True).alias("known"), F.count(F.lit(1)).alias("days")
    )
    unknown = payloads.unknown_ids(envelopes, known).select("location_id").distinct()
    return matched.unionByName(
        unknown.select("location_id", F.lit(False).alias("known"), F.lit(0).cast("long").alias("days"))
    )


# Per location: n days held, h humidity values, u distinct dates, and the outer dates.
@query(f"""WITH {PLAN_SQL},
units AS (
  SELECT p.work_id, p.start_date, p.end_date, p.days AS days, n.location_id,
    ROW_NUMBER() OVER (PARTITION BY p.work_id ORDER BY n.ordinal) AS position,
    ROW_NUMBER() OVER (PARTITION BY n.batch_number, p.work_id ORDER BY n.ordinal) AS again
  FROM plan p JOIN numbered n ON p.batch_number = n.batch_number),
held AS (
  SELECT u.work_id, u.position, u.location_id, u.days, ANY_VALUE(u.start_date) AS start_date,
    ANY_VALUE(u.end_date) AS end_date, COUNT(r.date) AS n, MIN(r.date) AS first_date, MAX(r.date) AS last_date
  FROM units u LEFT JOIN readings r ON r.location_id = u.location_id
    AND r.date BETWEEN u.start_date AND u.end_date
  GROUP BY u.work_id, u.position, u.location_id, u.days),
shaped AS (
  SELECT work_id, CAST(position AS INTEGER) AS position, days, n, start_date, end_date,
    location_id % 13 = 4 AS no_daily, location_id % 17 = 6 AS no_zone, location_id % 11 = 5 AS repeated,
    CASE WHEN location_id % 7 = 3 THEN GREATEST(n - 1, 0) ELSE n END AS h,
    CASE WHEN location_id % 11 = 5 AND n > 1 THEN n - 1 ELSE n END AS u,
    first_date, CASE WHEN location_id % 11 = 5 THEN first_date ELSE last_date END AS last_date
  FROM held),
found AS (
  SELECT work_id, position, 'missing_timezone' AS rule, CAST(NULL AS VARCHAR) AS observed, 'timezone' AS expected
  FROM shaped WHERE no_zone
  UNION ALL SELECT work_id, position, 'missing_daily', NULL, 'daily' FROM shaped WHERE no_daily
  UNION ALL SELECT work_id, position, 'day_count', CAST(n AS VARCHAR), CAST(days AS VARCHAR)
    FROM shaped WHERE NOT no_daily AND n <> days
  UNION ALL SELECT work_id, position, 'length_relative_humidity_2m_mean', CAST(h AS VARCHAR), CAST(n AS VARCHAR)
    FROM shaped WHERE NOT no_daily AND h <> n
  UNION ALL SELECT work_id, position, 'duplicate_dates', CAST(u AS VARCHAR), CAST(n AS VARCHAR)
    FROM shaped WHERE NOT no_daily AND u <> n
  UNION ALL SELECT work_id, position, 'no_dates', '0', CAST(days AS VARCHAR) FROM shaped WHERE NOT no_daily AND n = 0
  UNION ALL SELECT work_id, position, 'first_date', CAST(first_date AS VARCHAR), CAST(start_date AS VARCHAR)
    FROM shaped WHERE NOT no_daily AND n > 0 AND first_date <> start_date
  UNION ALL SELECT work_id, position, 'last_date', CAST(last_date AS VARCHAR), CAST(end_date AS VARCHAR)
    FROM shaped WHERE NOT no_daily AND n > 0 AND last_date <> end_date
  UNION ALL SELECT work_id, position, 'exact_dates', CAST(n AS VARCHAR), CAST(days AS VARCHAR)
    FROM shaped WHERE NOT no_daily AND (n <> days OR u <> n)
  UNION ALL SELECT work_id, 0, 'location_count', CAST(locations AS VARCHAR), '{BATCH}' FROM plan
    WHERE locations <> {BATCH})
SELECT work_id, position, rule, observed, expected FROM found""")
def payload_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Violations of payloads with planted defects; the last batch may also be short."""
    broken = landing.payloads(spark, sf_dir, planted=True)
    return rules.payload_violations(broken, F.lit(BATCH), strict_dates=True)


@query(f"""WITH {PLAN_SQL} SELECT work_id, locations + 1 AS ids, locations FROM plan WHERE batch_number % 2 = 0""")
def envelope_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Envelopes with one id too many in every other batch."""
    ids = F.col("location_ids")
    spare = F.when(F.col("batch_number") % 2 == 0, F.concat(ids, F.array(F.lit(-1).cast("long")))).otherwise(ids)
    envelopes = landing.payloads(spark, sf_dir).select(
        "work_id", F.struct(spare.alias("location_ids"), "locations").alias("envelope")
    )
    found = rules.envelope_violations(envelopes)
    return found.withColumns({"ids": F.col("ids").cast("long"), "locations": F.col("locations").cast("long")})
