"""Queries over the daily table: scans, projections, filters, aggregates, windows, top-k."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from obsgrid.functions import labels
from obsgrid.functions.columns import city_key, euclidean, finite, is_nonfinite, to_long, window_days, work_id
from obsgrid.functions.columns import WORK_ID_PATTERN
from obsgrid.operators import describe, ranking
from obsgrid.plans.registry import query
from obsgrid.schema import DAILY_SCHEMA, MEASURE_NAMES
from obsgrid.session import scratch_path
from obsgrid.sources import tables
from obsgrid.sources.catalogue import catalogue_rules as rules_of
from obsgrid.sources.catalogue import read_catalogue, select_places, write_catalogue
from obsgrid.sources.payloads import as_json_array, first_match as best_match, flatten_current
from obsgrid.sources.views import CATALOGUE_SQL, DAILY_COLUMNS, DAILY_SQL, catalogue, daily_obs, readings, table

CITY = "Supplier#000000001"
SPLIT = date(2000, 1, 1)
DAILY_LIST = ", ".join(DAILY_COLUMNS)


def daily_sql(body: str) -> str:
    return f"WITH {DAILY_SQL} {body}"


# ---- scans, sources, sinks -------------------------------------------------------------


@query(daily_sql("""
SELECT COUNT(*) AS total_rows, COUNT(DISTINCT location_id) AS locations,
  COUNT(DISTINCT city) AS cities, COUNT(DISTINCT country) AS countries,
  COUNT(DISTINCT year) AS years, MIN(date) AS min_date, MAX(date) AS max_date FROM daily_obs"""))
def scan_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return describe.dataset_summary(daily_obs(spark, sf_dir))


@query(daily_sql(f"""
SELECT {', '.join('CASE WHEN date < DATE ' + repr(str(SPLIT)) + ' THEN elevation END AS elevation'
                  if c == 'elevation' else c for c in DAILY_COLUMNS)},
  CASE WHEN date < DATE '{SPLIT}' THEN 'historical' ELSE 'recent' END AS layer
FROM daily_obs"""))
def union_layers(spark: SparkSession, sf_dir: str) -> DataFrame:
    daily = daily_obs(spark, sf_dir)
    historical = daily.where(F.col("date") < F.lit(SPLIT))
    recent = daily.where(F.col("date") >= F.lit(SPLIT)).drop("elevation")
    return tables.union_layers(historical, recent)


@query(daily_sql(f"""
SELECT location_id, date, year, precipitation_sum,
  CASE WHEN date < DATE '{SPLIT}' THEN elevation END AS elevation,
  CASE WHEN date >= DATE '{SPLIT}' THEN timezone END AS timezone FROM daily_obs"""))
def drifted_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files whose columns drifted apart, scanned as one table by column name."""
    daily = daily_obs(spark, sf_dir)
    common = ["location_id", "date", "year", "precipitation_sum"]
    old, new = scratch_path(spark, "old-columns"), scratch_path(spark, "new-columns")
    daily.where(F.col("date") < F.lit(SPLIT)).select(*common, "elevation").write.parquet(old)
    daily.where(F.col("date") >= F.lit(SPLIT)).select("timezone", *common).write.parquet(new)
    return tables.read_merged(spark, old, new)


@query(daily_sql("""
SELECT column_name, CAST(COUNT(*) AS BIGINT) AS required_rows FROM daily_obs,
  (VALUES ('location_id'), ('date'), ('temperature_mean'), ('precipitation_sum'), ('year')) v(column_name)
GROUP BY column_name"""))
def required_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The required columns, all present, with the rows behind them."""
    needed = ["location_id", "date", "temperature_mean", "precipitation_sum", "year"]
    daily = tables.require_columns(daily_obs(spark, sf_dir), needed)
    counted = daily.agg(*[F.count(F.lit(1)).alias(c) for c in needed])
    return counted.unpivot([], needed, "column_name", "required_rows")


@query(f"WITH {CATALOGUE_SQL} SELECT * REPLACE (city || ', ' || country AS city) FROM catalogue")
def catalogue_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The catalogue through its CSV form, names with quoted commas included."""
    path = scratch_path(spark, "catalogue")
    named = catalogue(spark, sf_dir).withColumn("city", F.concat_ws(", ", "city", "country"))
    write_catalogue(named, path)
    return read_catalogue(spark, path)


@query(daily_sql(f"SELECT {DAILY_LIST} FROM daily_obs"))
def write_partitioned(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The daily table written by year, its recent years written again, and read back."""
    root, staged = scratch_path(spark, "daily"), scratch_path(spark, "staged")
    daily_obs(spark, sf_dir).write.parquet(staged)
    daily = spark.read.schema(DAILY_SCHEMA).parquet(staged)
    tables.rebuild_daily(daily, root)
    tables.write_daily(daily.where(F.col("year") >= SPLIT.year), root)
    return tables.read_daily(spark, root)


@query(daily_sql(f"SELECT {DAILY_LIST} FROM daily_obs"))
def compact(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The partitioned table compacted to few ZSTD files, row for row."""
    source, target = scratch_path(spark, "daily"), scratch_path(spark, "compact")
    tables.rebuild_daily(daily_obs(spark, sf_dir), source)
    tables.compact(spark, source, target)
    return spark.read.parquet(target).select(*DAILY_SCHEMA.fieldNames())


@query(daily_sql("""
SELECT location_id, city, date, temperature_mean FROM daily_obs
ORDER BY location_id, date LIMIT 10"""))
def sample_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    daily = daily_obs(spark, sf_dir).select("location_id", "city", "date", "temperature_mean")
    return daily.orderBy("location_id", "date").limit(10)


@query(daily_sql("""
, weather AS (
  SELECT city, AVG(temperature_mean) AS temperature, AVG(precipitation_sum) AS rainfall,
    AVG(relative_humidity_mean) AS humidity FROM daily_obs GROUP BY city),
warm AS (SELECT city, temperature, rainfall, humidity FROM weather WHERE temperature > 50)
SELECT city, temperature, rainfall, humidity FROM warm"""))
def sql_view_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A temporary view queried with SQL: filter and descending sort."""
    weather = daily_obs(spark, sf_dir).groupBy("city").agg(
        F.avg("temperature_mean").alias("temperature"),
        F.avg("precipitation_sum").alias("rainfall"),
        F.avg("relative_humidity_mean").alias("humidity"),
    )
    return spark.sql(
        "SELECT city, temperature, rainfall, humidity FROM {weather} "
        "WHERE temperature > 50 ORDER BY temperature DESC",
        weather=weather,
    )


@query(daily_sql("""
SELECT AVG(temperature_mean) AS avg_temperature, AVG(precipitation_sum) AS avg_rainfall,
  AVG(relative_humidity_mean) AS avg_humidity FROM daily_obs"""))
def global_averages(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = {
        "avg_temperature": "temperature_mean",
        "avg_rainfall": "precipitation_sum",
        "avg_humidity": "relative_humidity_mean",
    }
    return describe.averages(readings(spark, sf_dir), names)


# ---- projections and filters -----------------------------------------------------------


@query(daily_sql(f"""
SELECT {DAILY_LIST} FROM daily_obs
WHERE city = '{CITY}' AND date BETWEEN DATE '1998-03-15' AND DATE '2000-06-30'"""))
def city_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    ids = ranking.ids_of(catalogue(spark, sf_dir), CITY)
    return ranking.city_range(daily_obs(spark, sf_dir), ids, date(1998, 3, 15), date(2000, 6, 30))


@query(daily_sql(f"SELECT {DAILY_LIST} FROM daily_obs WHERE city = '{CITY}'"))
def city_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranking.city_series(daily_obs(spark, sf_dir), ranking.ids_of(catalogue(spark, sf_dir), CITY))


@query(daily_sql(f"""
SELECT city, {', '.join(f'{c} AS "{n}"' for c, n in labels.DAILY_TABLE_NAMES.items())}
FROM daily_obs"""))
def daily_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranking.daily_table(daily_obs(spark, sf_dir))


CANDIDATES_SQL = """
candidates AS (
  SELECT c_custkey AS location_id, c_mktsegment || ' ' || CAST(c_custkey % 7 AS VARCHAR) AS city,
    c_mktsegment || ' ' || CAST(c_custkey % 7 AS VARCHAR) AS city_ascii, n_name AS country,
    'N' || CAST(n_nationkey AS VARCHAR) AS iso2,
    'N' || LPAD(CAST(n_nationkey AS VARCHAR), 2, '0') AS iso3, n_name AS admin_name,
    CAST(NULL AS VARCHAR) AS capital,
    CASE WHEN c_custkey % 50 <> 7 THEN CAST((c_custkey * 37) % 201 - 100 AS DOUBLE) END AS latitude,
    CAST((c_custkey * 53) % 361 - 180 AS DOUBLE) AS longitude,
    CASE WHEN c_acctbal > 0 THEN CAST(FLOOR(c_acctbal * 1000) AS DOUBLE) END AS population
  FROM customer JOIN nation ON c_nationkey = n_nationkey)"""


def candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers as candidate places; some share a name, some lack or break coordinates."""
    key = F.col("c_custkey")
    name = F.concat_ws(" ", "c_mktsegment", (key % 7).cast("string"))
    return (
        table(spark, sf_dir, "customer")
        .join(table(spark, sf_dir, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
        .select(
            key.alias("location_id"),
            name.alias("city"),
            name.alias("city_ascii"),
            F.col("n_name").alias("country"),
            F.concat(F.lit("N"), F.col("n_nationkey").cast("string")).alias("iso2"),
            F.concat(F.lit("N"), F.lpad(F.col("n_nationkey").cast("string"), 2, "0")).alias("iso3"),
            F.col("n_name").alias("admin_name"),
            F.lit(None).cast("string").alias("capital"),
            F.when(key % 50 != 7, ((key * 37) % 201 - 100).cast("double")).alias("latitude"),
            ((key * 53) % 361 - 180).cast("double").alias("longitude"),
            F.when(F.col("c_acctbal") > 0, F.floor(F.col("c_acctbal") * 1000).cast("double")).alias(
                "population"
            ),
        )
    )


SELECTED_SQL = f"""{CANDIDATES_SQL},
valid AS (
  SELECT *, UPPER(TRIM(iso3)) || '::' || LOWER(TRIM(city_ascii)) AS city_key FROM candidates
  WHERE latitude BETWEEN -90 AND 90 AND longitude BETWEEN -180 AND 180),
named AS (
  SELECT * FROM valid QUALIFY ROW_NUMBER() OVER (
    PARTITION BY city_key ORDER BY population DESC NULLS LAST, location_id) = 1),
ranked AS (
  SELECT *, ROW_NUMBER() OVER (
    PARTITION BY iso3 ORDER BY population DESC NULLS LAST, location_id) AS place_rank
  FROM named WHERE population >= 100000),
leaders AS (
  SELECT * FROM ranked WHERE place_rank = 1 ORDER BY population DESC, location_id LIMIT 20),
extras AS (
  SELECT * FROM ranked WHERE iso3 IN (SELECT iso3 FROM leaders)
    AND location_id NOT IN (SELECT location_id FROM leaders) AND place_rank <= 3
  ORDER BY population DESC, location_id LIMIT 30),
selected AS (
  SELECT * EXCLUDE (city_key, place_rank) FROM leaders
  UNION ALL SELECT * EXCLUDE (city_key, place_rank) FROM extras)"""


def _selected(spark: SparkSession, sf_dir: str) -> DataFrame:
    return select_places(candidates(spark, sf_dir), target=50, countries=20, per_country=3)


@query(f"WITH {SELECTED_SQL} SELECT * FROM selected")
def catalogue_select(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _selected(spark, sf_dir)


@query(f"""WITH {SELECTED_SQL},
facts AS (SELECT COUNT(*) AS n, COUNT(DISTINCT location_id) AS ids, COUNT(DISTINCT iso3) AS codes,
  (SELECT MAX(c) FROM (SELECT COUNT(*) AS c FROM selected GROUP BY iso3)) AS largest FROM selected),
rules AS (
  SELECT 'rows' AS rule, n AS observed, 50 AS expected, n = 50 AS ok FROM facts
  UNION ALL SELECT 'duplicate_ids', n - ids, 0, n = ids FROM facts
  UNION ALL SELECT 'missing_codes', (SELECT COUNT(*) FROM selected WHERE iso3 IS NULL), 0, TRUE FROM facts
  UNION ALL SELECT 'missing_coordinates', 0, 0, TRUE FROM facts
  UNION ALL SELECT 'outside_globe', 0, 0, TRUE FROM facts
  UNION ALL SELECT 'largest_country', largest, 3, largest <= 3 FROM facts
  UNION ALL SELECT 'countries', codes, 20, codes >= 20 FROM facts)
SELECT rule, CAST(observed AS BIGINT) AS observed, CAST(expected AS BIGINT) AS expected,
  CASE WHEN ok THEN 'PASS' ELSE 'FAIL' END AS status FROM rules""")
def catalogue_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rules_of(_selected(spark, sf_dir), expected=50, countries=20, per_country=3)


@query(f"""WITH {CATALOGUE_SQL}, per AS (SELECT country, COUNT(*) AS places FROM catalogue GROUP BY country)
SELECT places, COUNT(*) AS countries FROM per GROUP BY places""")
def country_distribution(spark: SparkSession, sf_dir: str) -> DataFrame:
    return describe.country_distribution(catalogue(spark, sf_dir))


@query("""
SELECT event_id, CAST(strptime(strftime(ts, '%Y-%m-%d'), '%Y-%m-%d') AS DATE) AS date,
  TRY_CAST(CASE WHEN event_type = 'error' THEN 'n/a' ELSE CAST(event_id AS VARCHAR) END AS DOUBLE) AS value
FROM events""")
def typed_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Strict dates, lenient numbers: bad dates fail the job, bad numbers become NULL."""
    texts = table(spark, sf_dir, "events").select(
        "event_id",
        F.date_format("ts", "yyyy-MM-dd").alias("day"),
        F.when(F.col("event_type") == "error", "n/a")
        .otherwise(F.col("event_id").cast("string"))
        .alias("number"),
    )
    return texts.select(
        "event_id", F.col("day").cast("date").alias("date"), F.expr("try_cast(number AS double)").alias("value")
    )


@query("""
SELECT event_id, CAST(json_extract(props, '$.k') AS INTEGER) AS k FROM events""")
def json_normalize(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Objects and arrays of objects read alike; half of the texts are arrays."""
    text = F.when(F.col("event_id") % 2 == 0, F.col("props")).otherwise(
        F.concat(F.lit("["), "props", F.lit("]"))
    )
    parsed = F.from_json(as_json_array(text), "array<struct<k:int>>")
    return table(spark, sf_dir, "events").select("event_id", F.inline(parsed))


def _current_payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as stored current-conditions payloads; some keys are absent."""
    k = F.get_json_object("props", "$.k").cast("int")
    current = F.struct(
        F.date_format("ts", "yyyy-MM-dd'T'HH:mm").alias("time"),
        F.when(F.col("event_type") != "error", F.col("value")).alias("temperature_2m"),
        k.cast("double").alias("relative_humidity_2m"),
        F.when(k > 50, F.lit(1.5)).alias("precipitation"),
        F.lit(3.25).alias("wind_speed_10m"),
        F.lit(1000.0).alias("surface_pressure"),
        k.alias("weather_code"),
        (F.col("event_id") % 3).cast("int").alias("is_day"),
    )
    payload = F.struct(
        F.when(F.col("event_type") == "view", "Zone/A").alias("timezone"), current.alias("current")
    )
    return table(spark, sf_dir, "events").select("event_id", F.to_json(payload).alias("payload"))


@query("""
SELECT event_id, strftime(ts, '%Y-%m-%dT%H:%M') AS time,
  CASE WHEN event_type <> 'error' THEN value END AS temperature_c,
  CAST(json_extract(props, '$.k') AS DOUBLE) AS humidity_percent,
  CASE WHEN CAST(json_extract(props, '$.k') AS INTEGER) > 50 THEN 1.5::DOUBLE END AS precipitation_mm,
  3.25::DOUBLE AS wind_speed_kmh, 1000.0::DOUBLE AS pressure_hpa,
  CAST(json_extract(props, '$.k') AS INTEGER) AS weather_code,
  CAST(event_id % 3 AS INTEGER) AS is_day,
  CASE WHEN event_type = 'view' THEN 'Zone/A' ELSE 'auto' END AS timezone
FROM events""")
def current_flatten(spark: SparkSession, sf_dir: str) -> DataFrame:
    return flatten_current(_current_payloads(spark, sf_dir))


@query("""
SELECT event_id,
  CASE WHEN event_type IN ('click', 'purchase') THEN 'first ' || CAST(user_id AS VARCHAR) END AS name,
  CASE WHEN event_type = 'click' THEN 'here' WHEN event_type = 'purchase' THEN '' END AS country,
  CASE WHEN event_type IN ('click', 'purchase') THEN '' END AS country_code,
  CASE WHEN event_type IN ('click', 'purchase') THEN '' END AS admin1,
  CASE WHEN event_type IN ('click', 'purchase') THEN value END AS latitude,
  CASE WHEN event_type IN ('click', 'purchase') THEN value + 0.5::DOUBLE END AS longitude,
  CASE WHEN event_type = 'click' THEN 'Zone/A' WHEN event_type = 'purchase' THEN 'auto' END AS timezone,
  CASE WHEN event_type IN ('click', 'purchase') THEN 'ok' WHEN event_type = 'view'
    THEN 'incomplete match' ELSE 'no match' END AS outcome
FROM events""")
def first_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ranked geocoding results; only the first counts. Some are empty or incomplete."""
    kind = F.col("event_type")
    click = kind == "click"

    def result(prefix: str, latitude) -> Column:
        return F.struct(
            F.concat_ws(" ", F.lit(prefix), F.col("user_id").cast("string")).alias("name"),
            F.when(click, "here").alias("country"),
            latitude.alias("latitude"),
            (F.col("value") + 0.5).alias("longitude"),
            F.when(click, "Zone/A").alias("timezone"),
        )

    ranked = F.array(
        result("first", F.when(kind != "view", F.col("value"))), result("second", F.col("value"))
    )
    results = F.when(kind.isin("click", "purchase", "view"), ranked).otherwise(
        F.slice(ranked, F.lit(1), F.lit(0))
    )
    payloads = table(spark, sf_dir, "events").select(
        "event_id", F.to_json(F.struct(results.alias("results"))).alias("payload")
    )
    return best_match(payloads)


def _sql_codes(column: str, texts: dict) -> str:
    cases = " ".join(f"WHEN {k} THEN '{v}'" for k, v in texts.items())
    return f"CASE {column} {cases}"


@query(f"""
WITH codes AS (SELECT event_id, CAST(json_extract(props, '$.k') AS INTEGER) AS code,
  CAST(event_id % 3 AS INTEGER) AS is_day FROM events)
SELECT event_id, code,
  {_sql_codes('code', labels.WEATHER_CODES)} ELSE '{labels.UNKNOWN_CONDITION}' END AS condition,
  CASE is_day WHEN 1 THEN 'Day' WHEN 0 THEN 'Night' ELSE 'N/A' END AS day_night,
  {_sql_codes('code % 5', labels.CLUSTER_NAMES)} END AS cluster_name
FROM codes""")
def code_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events").select(
        "event_id",
        F.get_json_object("props", "$.k").cast("int").alias("code"),
        (F.col("event_id") % 3).cast("int").alias("is_day"),
    )
    return events.select(
        "event_id",
        "code",
        labels.weather_text(F.col("code")).alias("condition"),
        labels.day_or_night(F.col("is_day")).alias("day_night"),
        labels.lookup(F.col("code") % 5, labels.CLUSTER_NAMES).alias("cluster_name"),
    )


# ---- aggregates ------------------------------------------------------------------------


@query(daily_sql("""
SELECT city, country, COUNT(*) AS row_count, MIN(date) AS min_date, MAX(date) AS max_date
FROM daily_obs GROUP BY city, country"""))
def rows_per_city(spark: SparkSession, sf_dir: str) -> DataFrame:
    return describe.rows_per_city(daily_obs(spark, sf_dir))


@query(daily_sql("""
, per AS (SELECT city, country, COUNT(*) AS row_count FROM daily_obs GROUP BY city, country)
SELECT row_count, COUNT(*) AS cities FROM per GROUP BY row_count"""))
def row_count_distribution(spark: SparkSession, sf_dir: str) -> DataFrame:
    return describe.row_count_distribution(daily_obs(spark, sf_dir))


CHECKED = ("location_id", "city", "country", "date", *MEASURE_NAMES)


def _with_holes(daily: DataFrame) -> DataFrame:
    """The daily table with some measures missing, for rules that look for them."""
    return daily.withColumns(
        {
            "temperature_mean": F.when(F.col("precipitation_sum") < 45, F.col("temperature_mean")),
            "wind_speed_mean": F.when(F.col("wind_speed_mean") > 0, F.col("wind_speed_mean")),
        }
    )


HOLES_SQL = f"""{DAILY_SQL}, holes AS (
  SELECT * REPLACE (
    CASE WHEN precipitation_sum < 45 THEN temperature_mean END AS temperature_mean,
    CASE WHEN wind_speed_mean > 0 THEN wind_speed_mean END AS wind_speed_mean) FROM daily_obs)"""


@query(f"WITH {HOLES_SQL} " + " UNION ALL ".join(
    f"SELECT '{c}' AS column_name, COUNT(*) - COUNT({c}) AS missing FROM holes" for c in CHECKED))
def missing_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    return describe.missing_values(_with_holes(daily_obs(spark, sf_dir)), CHECKED)


def _stats_sql(source: str, column: str) -> str:
    return f"""SELECT '{column}' AS variable, COUNT({column}) AS count,
  ROUND(AVG({column}), 6) AS mean, ROUND(STDDEV_SAMP({column}), 6) AS std,
  ROUND(MIN({column}), 6) AS minimum, ROUND(QUANTILE_CONT({column}, 0.25), 6) AS q25,
  ROUND(QUANTILE_CONT({column}, 0.5), 6) AS median, ROUND(QUANTILE_CONT({column}, 0.75), 6) AS q75,
  ROUND(MAX({column}), 6) AS maximum, ROUND(MAX({column}) - MIN({column}), 6) AS range FROM {source}"""


def round_columns(df: DataFrame, *columns: str, digits: int = 6) -> DataFrame:
    return df.withColumns({c: F.round(c, digits) for c in columns})


STATS = ("mean", "std", "minimum", "q25", "median", "q75", "maximum", "range")


@query(f"WITH {DAILY_SQL} " + " UNION ALL ".join(_stats_sql("daily_obs", m) for m in MEASURE_NAMES))
def global_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    stats = describe.column_statistics(readings(spark, sf_dir), MEASURE_NAMES)
    return round_columns(stats, *STATS)


TEMPERATURE_SQL = f"""{DAILY_SQL}, per AS (
  SELECT city, country, AVG(temperature_mean) AS avg_temperature,
    MIN(temperature_min) AS lowest_temperature, MAX(temperature_max) AS highest_temperature
  FROM daily_obs GROUP BY city, country)"""
RAIN_SQL = f"""{DAILY_SQL}, per AS (
  SELECT city, country, SUM(precipitation_sum) / COUNT(DISTINCT year) AS avg_yearly_precipitation,
    AVG(precipitation_sum) AS avg_daily_precipitation, MAX(precipitation_sum) AS max_daily_precipitation
  FROM daily_obs GROUP BY city, country)"""


@query(f"WITH {TEMPERATURE_SQL} SELECT * FROM per ORDER BY avg_temperature, city, country LIMIT 10")
def coldest10(spark: SparkSession, sf_dir: str) -> DataFrame:
    per = describe.temperature_by_city(daily_obs(spark, sf_dir))
    return ranking.top_cities(per, "avg_temperature", descending=False)


@query(f"WITH {TEMPERATURE_SQL} SELECT * FROM per ORDER BY avg_temperature DESC, city, country LIMIT 10")
def hottest10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranking.top_cities(describe.temperature_by_city(daily_obs(spark, sf_dir)), "avg_temperature")


@query(f"WITH {RAIN_SQL} SELECT * FROM per ORDER BY avg_yearly_precipitation DESC, city, country LIMIT 10")
def wettest10(spark: SparkSession, sf_dir: str) -> DataFrame:
    per = describe.precipitation_by_city(daily_obs(spark, sf_dir))
    return ranking.top_cities(per, "avg_yearly_precipitation")


@query(f"WITH {RAIN_SQL} SELECT * FROM per ORDER BY avg_yearly_precipitation, city, country LIMIT 10")
def driest10(spark: SparkSession, sf_dir: str) -> DataFrame:
    per = describe.precipitation_by_city(daily_obs(spark, sf_dir))
    return ranking.top_cities(per, "avg_yearly_precipitation", descending=False)


@query(daily_sql("""
SELECT CAST(EXTRACT(MONTH FROM date) AS INTEGER) AS month, AVG(temperature_mean) AS avg_temperature,
  AVG(temperature_max) AS avg_max_temperature, AVG(temperature_min) AS avg_min_temperature
FROM daily_obs GROUP BY 1"""))
def monthly_temp(spark: SparkSession, sf_dir: str) -> DataFrame:
    return describe.monthly_temperature(readings(spark, sf_dir))


@query(daily_sql("""
SELECT CAST(EXTRACT(MONTH FROM date) AS INTEGER) AS month,
  AVG(precipitation_sum) AS avg_daily_precipitation,
  SUM(precipitation_sum) / (SELECT COUNT(DISTINCT year) * COUNT(DISTINCT location_id) FROM daily_obs)
    AS avg_monthly_precipitation
FROM daily_obs GROUP BY 1"""))
def monthly_precip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return describe.monthly_precipitation(readings(spark, sf_dir))


@query(daily_sql("""
SELECT city, COUNT(temperature_mean) AS count, AVG(temperature_mean) AS mean,
  MIN(temperature_mean) AS minimum, MAX(temperature_mean) AS maximum,
  ROUND(QUANTILE_CONT(temperature_mean, 0.5), 6) AS median FROM daily_obs GROUP BY city"""))
def variable_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    summary = describe.variable_summary(daily_obs(spark, sf_dir), ["city"], "temperature_mean")
    return round_columns(summary, "median")


EDA_SQL = f"""{DAILY_SQL}, eda AS (
  SELECT city, COUNT(surface_pressure_mean) AS count, AVG(surface_pressure_mean) AS mean,
    ROUND(STDDEV_SAMP(surface_pressure_mean), 6) AS std, MIN(surface_pressure_mean) AS minimum,
    ROUND(QUANTILE_CONT(surface_pressure_mean, 0.25), 6) AS q1,
    ROUND(QUANTILE_CONT(surface_pressure_mean, 0.5), 6) AS median,
    ROUND(QUANTILE_CONT(surface_pressure_mean, 0.75), 6) AS q3,
    MAX(surface_pressure_mean) AS maximum,
    MAX(surface_pressure_mean) - MIN(surface_pressure_mean) AS range
  FROM daily_obs GROUP BY city)"""


def _eda(spark: SparkSession, sf_dir: str) -> DataFrame:
    summary = describe.eda_summary(daily_obs(spark, sf_dir), ["city"], "surface_pressure_mean")
    return round_columns(summary, "std", "q1", "median", "q3")


@query(f"WITH {EDA_SQL} SELECT * FROM eda")
def eda_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _eda(spark, sf_dir)


@query(f"WITH {EDA_SQL} " + " UNION ALL ".join(
    f"SELECT city, '{label}' AS statistic, CAST({c} AS DOUBLE) AS value, "
    f"'{'days' if c == 'count' else 'hPa'}' AS unit FROM eda"
    for c, label in labels.STATISTIC_LABELS.items()))
def eda_summary_long(spark: SparkSession, sf_dir: str) -> DataFrame:
    return describe.eda_summary_long(_eda(spark, sf_dir), ["city"], "hPa")


def _period_sql(period: str) -> str:
    measures = ", ".join(
        f"{'COALESCE(SUM' if m == 'precipitation_sum' else 'AVG'}({m})"
        f"{', 0.0::DOUBLE)' if m == 'precipitation_sum' else ''} AS {m}"
        for m in MEASURE_NAMES
    )
    return f"SELECT city, {period}, {measures} FROM daily_obs GROUP BY 1, 2"


@query(daily_sql(_period_sql("CAST(DATE_TRUNC('month', date) AS DATE) AS month")))
def monthly_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    return describe.monthly_series(daily_obs(spark, sf_dir), ["city"])


@query(daily_sql(_period_sql("year")))
def yearly_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    return describe.yearly_series(daily_obs(spark, sf_dir), ["city"])


@query(daily_sql("SELECT MIN(date) AS min_date, MAX(date) AS max_date FROM daily_obs"))
def date_bounds(spark: SparkSession, sf_dir: str) -> DataFrame:
    return describe.date_bounds(readings(spark, sf_dir))


@query(daily_sql("""
SELECT date, COUNT(*) AS rows, (SELECT COUNT(*) FROM catalogue) AS expected,
  COUNT(*) = (SELECT COUNT(*) FROM catalogue) AS complete
FROM daily_obs GROUP BY date"""))
def rows_per_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    places = catalogue(spark, sf_dir).agg(F.count(F.lit(1)).alias("n")).scalar()
    return describe.rows_per_date(readings(spark, sf_dir), places)


# ---- windows, top-k, selections --------------------------------------------------------


@query(f"""WITH {DAILY_SQL}, yearly AS (
  SELECT city, year, AVG(temperature_mean) AS temperature_mean, SUM(precipitation_sum) AS precipitation_sum
  FROM daily_obs GROUP BY city, year),
long AS (
  SELECT city, year, 'temperature_mean' AS variable, temperature_mean AS value FROM yearly
  UNION ALL SELECT city, year, 'precipitation_sum', precipitation_sum FROM yearly),
changed AS (
  SELECT *, value - LAG(value) OVER (PARTITION BY city, variable ORDER BY year) AS absolute_change,
    LAG(value) OVER (PARTITION BY city, variable ORDER BY year) AS before FROM long)
SELECT city, year, variable, value, absolute_change,
  CASE WHEN before <> 0 THEN absolute_change / before * 100 END AS percentage_change FROM changed""")
def yoy_change(spark: SparkSession, sf_dir: str) -> DataFrame:
    variables = ["temperature_mean", "precipitation_sum"]
    yearly = describe.yearly_series(daily_obs(spark, sf_dir), ["city"], variables)
    return ranking.year_over_year(to_long(yearly, ["city", "year"], variables), ["city", "variable"])


@query(daily_sql(f"""
SELECT {DAILY_LIST} FROM daily_obs
QUALIFY ROW_NUMBER() OVER (PARTITION BY location_id ORDER BY date DESC) = 1"""))
def latest_per_city(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranking.latest_per_city(daily_obs(spark, sf_dir))


@query(daily_sql("SELECT DISTINCT city, country FROM daily_obs"))
def distinct_cities(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranking.distinct_values(daily_obs(spark, sf_dir), "city", "country")


# ---- scalar functions ------------------------------------------------------------------

# Half-up is checked on exact decimals, where both engines agree on ties.
@query("""
SELECT l_orderkey, l_linenumber, l_partkey, l_quantity, l_shipdate::DATE AS ship_date,
  CAST(ROUND(CAST(FLOOR(l_extendedprice * 100.0::DOUBLE + 0.5::DOUBLE) AS DECIMAL(15, 0)) * 0.001, 2) AS DOUBLE)
    AS half_up,
  CAST(FLOOR(l_quantity / 2) + CASE WHEN l_quantity % 2 = 1 AND FLOOR(l_quantity / 2) % 2 = 1
    THEN 1 ELSE 0 END AS DOUBLE) AS half_even
FROM lineitem""")
def rounding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Half-up on exact decimals, half-even on halves."""
    cents = F.floor(F.col("l_extendedprice") * 100.0 + 0.5).cast("decimal(15,0)")
    return table(spark, sf_dir, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        "l_partkey",
        "l_quantity",
        F.col("l_shipdate").cast("date").alias("ship_date"),
        F.round(cents * F.lit("0.001").cast("decimal(4,3)"), 2).cast("double").alias("half_up"),
        F.bround(F.col("l_quantity") / 2).alias("half_even"),
    )


@query(f"""WITH {DAILY_SQL}
SELECT location_id, date,
  CASE WHEN precipitation_sum > 30 THEN 'wet' ELSE 'dry' END AS kind,
  CAST(EXTRACT(MONTH FROM date) AS INTEGER) AS month, year,
  CAST(DATE_TRUNC('month', date) AS DATE) AS month_start,
  CAST(date - DATE '1995-01-01' + 1 AS INTEGER) AS days_inclusive,
  CAST(date + 13 AS DATE) AS window_end,
  LEAST(CAST(date + 13 AS DATE), DATE '2001-11-01') AS clamped_end,
  CAST(SUBSTRING(CAST(date AS VARCHAR), 1, 4) AS INTEGER) AS year_of_text,
  UPPER(TRIM(iso3)) || '::' || LOWER(TRIM(city)) AS city_key,
  'batch_' || LPAD(CAST(location_id % 50 AS VARCHAR), 4, '0') || '__' || CAST(date AS VARCHAR) || '__'
    || CAST(CAST(date + 13 AS DATE) AS VARCHAR) AS work_id,
  CAST(location_id % 50 AS INTEGER) AS batch_of_name,
  city || ' — ' || country AS label, city AS city_of_label,
  ABS(source_latitude) AS absolute, source_latitude * source_latitude AS squared,
  SQRT((source_latitude - model_latitude) * (source_latitude - model_latitude)
    + (source_longitude - model_longitude) * (source_longitude - model_longitude)) AS distance,
  capital IS NULL AS no_capital, FALSE AS nonfinite,
  CAST(3 AS INTEGER) AS array_length, TRUE AS contains_city, country AS second_item,
  COALESCE(capital, 'none') AS json_capital,
  CASE WHEN capital IS NULL THEN 'N/A' ELSE CAST(CAST(precipitation_sum AS BIGINT) AS VARCHAR) || '.0 mm' END
    AS shown,
  CAST(date AS VARCHAR) || ',' || CAST(CAST(date + 1 AS DATE) AS VARCHAR) || ','
    || CAST(CAST(date + 2 AS DATE) AS VARCHAR) AS three_days,
  SHA256(city || '|' || CAST(date AS VARCHAR)) AS digest
FROM daily_obs""")
def scalar_suite(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The scalar functions in one projection."""
    day = F.col("date")
    end = F.date_add(day, 13)
    unit = work_id(F.col("location_id") % 50, day, end)
    label = labels.city_label(F.col("city"), F.col("country"))
    items = F.array("city", "country", "iso3")
    text = F.to_json(F.struct("city", "capital"))
    infinite = is_nonfinite(finite(F.col("source_latitude") / F.lit(2.0)))
    return daily_obs(spark, sf_dir).select(
        "location_id",
        "date",
        F.when(F.col("precipitation_sum") > 30, "wet").otherwise("dry").alias("kind"),
        F.month(day).alias("month"),
        F.year(day).alias("year"),
        F.trunc(day, "month").alias("month_start"),
        window_days(F.lit(date(1995, 1, 1)), day).alias("days_inclusive"),
        end.alias("window_end"),
        F.least(end, F.lit(date(2001, 11, 1))).alias("clamped_end"),
        F.substring(day.cast("string"), 1, 4).cast("int").alias("year_of_text"),
        city_key(F.col("iso3"), F.col("city")).alias("city_key"),
        unit.alias("work_id"),
        F.regexp_extract(unit, WORK_ID_PATTERN, 1).cast("int").alias("batch_of_name"),
        label.alias("label"),
        F.trim(F.split(label, "—")[0]).alias("city_of_label"),
        F.abs("source_latitude").alias("absolute"),
        (F.col("source_latitude") * F.col("source_latitude")).alias("squared"),
        euclidean(
            [F.col("source_latitude"), F.col("source_longitude")],
            [F.col("model_latitude"), F.col("model_longitude")],
        ).alias("distance"),
        F.col("capital").isNull().alias("no_capital"),
        infinite.alias("nonfinite"),
        F.size(items).alias("array_length"),
        F.array_contains(items, F.col("city")).alias("contains_city"),
        F.element_at(items, 2).alias("second_item"),
        F.coalesce(F.from_json(text, "capital string")["capital"], F.lit("none")).alias("json_capital"),
        labels.with_unit(F.when(F.col("capital").isNotNull(), F.col("precipitation_sum")), 1, " mm").alias(
            "shown"
        ),
        F.concat_ws(
            ",", F.transform(F.sequence(day, F.date_add(day, 2)), lambda d: d.cast("string"))
        ).alias("three_days"),
        F.sha2(F.concat_ws("|", "city", day.cast("string")), 256).alias("digest"),
    )


@query(f"""WITH {CATALOGUE_SQL}, numbered AS (
  SELECT *, ROW_NUMBER() OVER (ORDER BY location_id) AS ordinal FROM catalogue)
SELECT CAST((ordinal - 1) // 20 + 1 AS INTEGER) AS batch_number,
  STRING_AGG(CAST(CAST(latitude AS BIGINT) AS VARCHAR), ',' ORDER BY ordinal) AS latitudes,
  STRING_AGG(CAST(CAST(longitude AS BIGINT) AS VARCHAR), ',' ORDER BY ordinal) AS longitudes
FROM numbered GROUP BY 1""")
def batch_coordinates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Comma-joined coordinates of every request batch; a batch has a fixed size."""
    from obsgrid.streaming.workplan import number_places

    rows = F.array_sort(F.collect_list(F.struct("ordinal", "latitude", "longitude")))
    batches = number_places(catalogue(spark, sf_dir)).groupBy("batch_number").agg(rows.alias("rows"))

    def joined(field: str) -> Column:
        return F.concat_ws(",", F.transform("rows", lambda r: r[field].cast("long").cast("string")))

    return batches.select(
        "batch_number", joined("latitude").alias("latitudes"), joined("longitude").alias("longitudes")
    )


