"""Queries over place profiles: features, serving tables, similarity and clusters."""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from obsgrid.functions import labels
from obsgrid.operators import clusters, describe, features, neighbours, ranking, serving, similarity
from obsgrid.operators.quality import assignment_report
from obsgrid.plans.observations import CITY, _stats_sql, round_columns
from obsgrid.plans.registry import query, rounded
from obsgrid.schema import IDENTITY, PROFILE_MEASURES, SERVING_MEASURES, SERVING_NAMES
from obsgrid.session import scratch_path
from obsgrid.sources.views import DAILY_SQL, catalogue, given_clusters, readings, with_identity

WET_DAY = 30.0
OTHER = "Supplier#000000002"
FEATURES = features.FEATURES
IDENTITY_LIST = ", ".join(IDENTITY)

MONTHS_SQL = """months AS (
  SELECT location_id, EXTRACT(MONTH FROM date) AS month, AVG(temperature_mean) AS t,
    SUM(precipitation_sum) AS p FROM daily_obs GROUP BY 1, 2),
years AS (SELECT location_id, COUNT(DISTINCT year) AS years FROM daily_obs GROUP BY 1),
seasons AS (
  SELECT m.location_id, MAX(t) - MIN(t) AS temperature_seasonality,
    (MAX(p) - MIN(p)) / MAX(years) AS precipitation_seasonality
  FROM months m JOIN years y ON m.location_id = y.location_id GROUP BY m.location_id)"""

FEATURES_SQL = f"""{DAILY_SQL}, {MONTHS_SQL},
base AS (
  SELECT {IDENTITY_LIST}, COUNT(*) AS observation_days,
    AVG(temperature_mean) AS mean_temperature, STDDEV_SAMP(temperature_mean) AS temperature_std,
    AVG(temperature_max - temperature_min) AS mean_diurnal_range,
    QUANTILE_CONT(temperature_mean, 0.1) AS temperature_p10,
    QUANTILE_CONT(temperature_mean, 0.9) AS temperature_p90,
    QUANTILE_CONT(temperature_mean, 0.9) - QUANTILE_CONT(temperature_mean, 0.1) AS temperature_p90_p10_range,
    SUM(precipitation_sum) / COUNT(DISTINCT year) AS annual_precipitation,
    STDDEV_SAMP(precipitation_sum) AS precipitation_std,
    AVG(CASE WHEN precipitation_sum > {WET_DAY} THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END) AS wet_day_frequency,
    MAX(precipitation_sum) AS maximum_daily_precipitation,
    AVG(relative_humidity_mean) AS mean_humidity, STDDEV_SAMP(relative_humidity_mean) AS humidity_std,
    AVG(wind_speed_mean) AS mean_wind, STDDEV_SAMP(wind_speed_mean) AS wind_std
  FROM daily_obs GROUP BY {IDENTITY_LIST}),
features AS (
  SELECT b.*, temperature_seasonality, precipitation_seasonality
  FROM base b JOIN seasons s ON b.location_id = s.location_id)"""

PROFILE_SQL = f"""{DAILY_SQL},
profile AS (
  SELECT {IDENTITY_LIST}, {', '.join(f'AVG({m}) AS {m}' for m in PROFILE_MEASURES)},
    COUNT(*) AS daily_observation_count
  FROM daily_obs GROUP BY {IDENTITY_LIST}),
serving AS (
  SELECT p.location_id, p.city, p.country, latitude, longitude,
    CAST(p.location_id % 4 AS INTEGER) AS cluster_id,
    {', '.join(f'{m} AS {SERVING_NAMES[m]}' for m in PROFILE_MEASURES)}
  FROM profile p LEFT JOIN catalogue c ON p.location_id = c.location_id),
z AS (
  SELECT *, {', '.join(f'({c} - AVG({c}) OVER ()) / STDDEV_POP({c}) OVER () AS {c}_z' for c in SERVING_MEASURES)}
  FROM serving)"""


def climate(spark: SparkSession, sf_dir: str) -> DataFrame:
    per = features.climate_features(readings(spark, sf_dir), ["location_id"], wet_day=WET_DAY)
    return with_identity(per, spark, sf_dir)


def profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_identity(
        features.city_profile(readings(spark, sf_dir), ["location_id"]), spark, sf_dir
    )


def serve(spark: SparkSession, sf_dir: str) -> DataFrame:
    assigned = given_clusters(profile(spark, sf_dir))
    return serving.serving_table(assigned, catalogue(spark, sf_dir))


def standardised(spark: SparkSession, sf_dir: str) -> DataFrame:
    return similarity.standardise(serve(spark, sf_dir), SERVING_MEASURES)


# ---- features and profiles -------------------------------------------------------------


@query(f"""WITH {FEATURES_SQL}
SELECT {IDENTITY_LIST}, observation_days, {rounded(FEATURES)} FROM features""")
def climate_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    return round_columns(climate(spark, sf_dir), *FEATURES)


@query(f"""WITH {DAILY_SQL}, {MONTHS_SQL}
SELECT location_id, {rounded(['temperature_seasonality', 'precipitation_seasonality'])} FROM seasons""")
def seasonality(spark: SparkSession, sf_dir: str) -> DataFrame:
    seasons = features.seasonality(readings(spark, sf_dir))
    return round_columns(seasons, "temperature_seasonality", "precipitation_seasonality")


@query(f"WITH {PROFILE_SQL} SELECT * FROM profile")
def city_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile(spark, sf_dir)


@query(f"WITH {FEATURES_SQL} " + " UNION ALL ".join(_stats_sql("features", c) for c in FEATURES))
def feature_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    stats = describe.column_statistics(climate(spark, sf_dir), FEATURES)
    return round_columns(stats, "mean", "std", "minimum", "q25", "median", "q75", "maximum", "range")


@query(f"WITH {FEATURES_SQL} " + " UNION ALL ".join(
    f"SELECT '{c}' AS variable, ROUND(MIN({c}), 6) AS minimum, ROUND(MAX({c}), 6) AS maximum, "
    f"ROUND(MAX({c}) - MIN({c}), 6) AS range FROM features" for c in FEATURES))
def feature_ranges(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranges = describe.feature_ranges(climate(spark, sf_dir), FEATURES)
    return round_columns(ranges, "minimum", "maximum", "range").orderBy(F.col("range").desc())


@query(f"WITH {FEATURES_SQL} " + " UNION ALL ".join(
    f"SELECT '{c}' AS variable, ROUND(SKEWNESS({c}), 6) AS skewness FROM features" for c in FEATURES))
def feature_skew(spark: SparkSession, sf_dir: str) -> DataFrame:
    skew = describe.feature_skewness(climate(spark, sf_dir), FEATURES)
    return round_columns(skew, "skewness").orderBy(F.col("skewness").desc(), "variable")


PAIRS_SQL = f"WITH {FEATURES_SQL}, pairs AS (" + " UNION ALL ".join(
    f"SELECT '{a}' AS variable_1, '{b}' AS variable_2, CORR({a}, {b}) AS correlation FROM features"
    for a, b in combinations(FEATURES, 2)) + ")"


@query(f"""{PAIRS_SQL} SELECT variable_1, variable_2, ROUND(correlation, 6) AS correlation,
ROUND(ABS(correlation), 6) AS abs_correlation FROM pairs""")
def corr_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    pairs = describe.correlation_pairs(climate(spark, sf_dir), FEATURES)
    return round_columns(pairs, "correlation", "abs_correlation")


@query(f"""{PAIRS_SQL} SELECT variable_1, variable_2, ROUND(correlation, 6) AS correlation,
ROUND(ABS(correlation), 6) AS abs_correlation FROM pairs
ORDER BY ABS(correlation) DESC, variable_1, variable_2 LIMIT 20""")
def corr_top20(spark: SparkSession, sf_dir: str) -> DataFrame:
    pairs = describe.correlation_pairs(climate(spark, sf_dir), FEATURES, top=20)
    return round_columns(pairs, "correlation", "abs_correlation")


EXTREME_FEATURES = (
    "mean_temperature", "temperature_std", "temperature_seasonality", "annual_precipitation",
    "wet_day_frequency", "mean_humidity", "mean_wind",
)


@query(f"WITH {FEATURES_SQL}, long AS (" + " UNION ALL ".join(
    f"SELECT location_id, city, '{c}' AS variable, ROUND({c}, 6) AS value FROM features"
    for c in EXTREME_FEATURES) + """),
ranked AS (
  SELECT *, 'highest' AS direction, ROW_NUMBER() OVER (
    PARTITION BY variable ORDER BY value DESC, city, location_id) AS rank FROM long
  UNION ALL SELECT *, 'lowest', ROW_NUMBER() OVER (
    PARTITION BY variable ORDER BY value, city, location_id) FROM long)
SELECT city, location_id, variable, value, direction, CAST(rank AS INTEGER) AS rank
FROM ranked WHERE rank <= 5""")
def extremes(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = round_columns(climate(spark, sf_dir), *EXTREME_FEATURES)
    return ranking.extremes(df, ["city", "location_id"], EXTREME_FEATURES)


@query(f"WITH {FEATURES_SQL} " + " UNION ALL ".join(
    f"SELECT location_id, city, '{c}' AS variable, '{t[0]}' AS display_name, "
    f"CASE WHEN {c} IS NULL THEN 'N/A' ELSE PRINTF('%.3f', {c}) END AS value, "
    f"'{t[1]}' AS unit, '{t[2]}' AS meaning FROM features"
    for c, t in labels.FEATURE_TEXTS.items()))
def feature_long(spark: SparkSession, sf_dir: str) -> DataFrame:
    return serving.feature_long(climate(spark, sf_dir), ["location_id", "city"])


# ---- serving ---------------------------------------------------------------------------


@query(f"WITH {PROFILE_SQL} SELECT * FROM serving")
def serving_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return serve(spark, sf_dir)


@query(f"""WITH {PROFILE_SQL}
SELECT location_id, city FROM profile
WHERE location_id NOT IN (SELECT location_id FROM catalogue WHERE population > 3000000)""")
def unmatched_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Profiles without a catalogue entry, the catalogue being cut to its large places."""
    large = catalogue(spark, sf_dir).where(F.col("population") > 3_000_000)
    return serving.unmatched(profile(spark, sf_dir).select("location_id", "city"), large, "location_id")


@query(f"""WITH {PROFILE_SQL}, {MONTHS_SQL},
eda AS (SELECT s.location_id, city, country, temperature_seasonality FROM seasons s
  JOIN catalogue c ON s.location_id = c.location_id WHERE population > 3000000)
SELECT v.*, e.location_id AS location_id_eda, e.country AS country_eda,
  ROUND(temperature_seasonality, 6) AS temperature_seasonality
FROM serving v LEFT JOIN eda e ON v.city = e.city""")
def location_details(spark: SparkSession, sf_dir: str) -> DataFrame:
    large = catalogue(spark, sf_dir).where(F.col("population") > 3_000_000)
    seasons = features.seasonality(readings(spark, sf_dir)).join(
        large.select("location_id", "city", "country"), "location_id"
    )
    eda = round_columns(seasons, "temperature_seasonality").select(
        "location_id", "city", "country", "temperature_seasonality"
    )
    return serving.location_details(serve(spark, sf_dir), eda)


CLUSTER_NAME_SQL = "CASE cluster_id " + " ".join(
    f"WHEN {k} THEN '{v}'" for k, v in labels.CLUSTER_NAMES.items()) + " END"
RGBA_SQL = "CASE cluster_id " + " ".join(
    f"WHEN {k} THEN '{','.join(map(str, v))}'" for k, v in labels.CLUSTER_RGBA.items()) + " END"
COLOUR_SQL = "CASE cluster_id " + " ".join(
    f"WHEN {k} THEN '{v}'" for k, v in labels.CLUSTER_COLOURS.items()) + " END"


@query(f"""WITH {PROFILE_SQL}
SELECT location_id, city, country, latitude, longitude, {CLUSTER_NAME_SQL} AS cluster_name,
  {COLOUR_SQL} AS marker_colour, {RGBA_SQL} AS marker_rgba,
  CAST({labels.MARKER_RADIUS} AS INTEGER) AS marker_radius FROM serving""")
def map_layer(spark: SparkSession, sf_dir: str) -> DataFrame:
    return serving.map_layer(serve(spark, sf_dir))


@query(f"""WITH {PROFILE_SQL}
SELECT city, country, {CLUSTER_NAME_SQL} AS weather_pattern,
  {', '.join(f'ROUND_EVEN({c}, 2) AS {c}' for c in SERVING_MEASURES)} FROM serving""")
def city_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return serving.city_table(serve(spark, sf_dir))


@query(f"WITH {PROFILE_SQL} SELECT * FROM serving WHERE cluster_id IN (1, 3)")
def cluster_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranking.in_clusters(serve(spark, sf_dir), [1, 3])


@query(f"""WITH {PROFILE_SQL}
SELECT COUNT(*) AS locations, COUNT(DISTINCT country) AS countries, COUNT(DISTINCT cluster_id) AS clusters,
  ROUND(AVG(temperature_c), 6) AS mean_temperature FROM serving WHERE cluster_id IN (0, 2)""")
def overview(spark: SparkSession, sf_dir: str) -> DataFrame:
    chosen = ranking.in_clusters(serve(spark, sf_dir), [0, 2])
    return round_columns(describe.overview(chosen), "mean_temperature")


# ---- standardisation and similarity ----------------------------------------------------

Z = [f"{m}_z" for m in PROFILE_MEASURES]


def _z_sql(deviation: str) -> str:
    return ", ".join(
        f"ROUND(({m} - AVG({m}) OVER ()) / {deviation}({m}) OVER (), 6) AS {m}_z" for m in PROFILE_MEASURES
    )


@query(f"WITH {PROFILE_SQL} SELECT {IDENTITY_LIST}, {_z_sql('STDDEV_POP')} FROM profile")
def zscore_pop(spark: SparkSession, sf_dir: str) -> DataFrame:
    z = similarity.standardise(profile(spark, sf_dir), PROFILE_MEASURES)
    return round_columns(z.select(*IDENTITY, *Z), *Z)


@query(f"WITH {PROFILE_SQL} SELECT {IDENTITY_LIST}, {_z_sql('STDDEV_SAMP')} FROM profile")
def zscore_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    z = similarity.standardise(profile(spark, sf_dir), PROFILE_MEASURES, population=False)
    return round_columns(z.select(*IDENTITY, *Z), *Z)


@query(f"WITH {PROFILE_SQL} " + " UNION ALL ".join(
    f"SELECT '{c}_z' AS variable, ABS(AVG({c}_z)) < 1e-10 AS centred, "
    f"COUNT(*) FILTER (WHERE ISNAN({c}_z) OR ISINF({c}_z)) AS nonfinite FROM z" for c in SERVING_MEASURES))
def zscore_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    return similarity.standardisation_check(
        standardised(spark, sf_dir), [f"{c}_z" for c in SERVING_MEASURES]
    )


PAIR_SQL = f"""WITH {PROFILE_SQL},
a AS (SELECT * FROM z WHERE city = '{CITY}'), b AS (SELECT * FROM z WHERE city = '{OTHER}')"""


@query(f"{PAIR_SQL} " + " UNION ALL ".join(
    f"SELECT '{c}' AS variable, a.{c} AS city_a, b.{c} AS city_b, a.{c} - b.{c} AS difference, "
    f"ABS(a.{c} - b.{c}) AS absolute_difference FROM a, b" for c in SERVING_MEASURES))
def pair_compare(spark: SparkSession, sf_dir: str) -> DataFrame:
    return similarity.pair_compare(standardised(spark, sf_dir), CITY, OTHER)


def _squares(left: str, right: str) -> str:
    return " + ".join(f"({left}.{c}_z - {right}.{c}_z) ** 2" for c in SERVING_MEASURES)


@query(f"""{PAIR_SQL}
SELECT a.city AS city_a, b.city AS city_b, a.country AS country_a, b.country AS country_b,
  a.cluster_id AS cluster_a, b.cluster_id AS cluster_b, a.cluster_id = b.cluster_id AS same_cluster,
  ROUND(SQRT({_squares('a', 'b')}), 6) AS standardized_distance FROM a, b""")
def pair_distance(spark: SparkSession, sf_dir: str) -> DataFrame:
    pair = similarity.pair_distance(standardised(spark, sf_dir), CITY, OTHER)
    return round_columns(pair, "standardized_distance")


@query(f"{PAIR_SQL} " + " UNION ALL ".join(
    f"SELECT '{c}' AS variable, ROUND(ABS(a.{c}_z - b.{c}_z), 6) AS standardized_difference, "
    f"ROUND((a.{c}_z - b.{c}_z) ** 2 / ({_squares('a', 'b')}), 6) AS distance_contribution FROM a, b"
    for c in SERVING_MEASURES))
def distance_contrib(spark: SparkSession, sf_dir: str) -> DataFrame:
    shares = similarity.distance_contributions(standardised(spark, sf_dir), CITY, OTHER)
    return round_columns(shares, "standardized_difference", "distance_contribution")


@query(f"""WITH {PROFILE_SQL}, t AS (SELECT * FROM z WHERE city = '{CITY}')
SELECT z.city, z.country, z.cluster_id, ROUND(SQRT({_squares('t', 'z')}), 6) AS distance
FROM z, t WHERE z.city <> t.city ORDER BY SQRT({_squares('t', 'z')}), z.city LIMIT 5""")
def nearest_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return round_columns(similarity.nearest_to(standardised(spark, sf_dir), CITY), "distance")


@query(f"""WITH {PROFILE_SQL}, ranked AS (
  SELECT a.location_id, a.city, b.location_id AS neighbour_id, b.city AS neighbour,
    SQRT({_squares('a', 'b')}) AS distance,
    ROW_NUMBER() OVER (PARTITION BY a.location_id
      ORDER BY SQRT({_squares('a', 'b')}), b.city, b.location_id) AS rank
  FROM z a JOIN z b ON a.location_id <> b.location_id)
SELECT location_id, city, CAST(rank AS INTEGER) AS rank, neighbour_id, neighbour,
  ROUND(distance, 6) AS distance FROM ranked WHERE rank <= 5""")
def nearest_k_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five nearest profiles of every place."""
    z = [f"{c}_z" for c in SERVING_MEASURES]
    return round_columns(neighbours.nearest_all(standardised(spark, sf_dir), z), "distance")


@query(f"WITH {PROFILE_SQL} " + " UNION ALL ".join(
    f"SELECT location_id, city, cluster_id, '{c}' AS variable, {c} AS location_value, "
    f"ROUND(AVG({c}) OVER (PARTITION BY cluster_id), 6) AS cluster_average, "
    f"ROUND({c} - AVG({c}) OVER (PARTITION BY cluster_id), 6) AS difference FROM serving"
    for c in SERVING_MEASURES))
def cluster_deviation(spark: SparkSession, sf_dir: str) -> DataFrame:
    deviation = similarity.cluster_deviation(serve(spark, sf_dir))
    return round_columns(deviation, "cluster_average", "difference")


# ---- clusters over a given assignment --------------------------------------------------


@query(f"""WITH {PROFILE_SQL}
SELECT cluster_id, COUNT(*) AS locations,
  {', '.join(f'ROUND(AVG({c}), 6) AS {c}' for c in SERVING_MEASURES)} FROM serving GROUP BY cluster_id""")
def cluster_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return round_columns(clusters.cluster_profile(serve(spark, sf_dir)), *SERVING_MEASURES)


FULL = [f"{c}_{part}" for c in SERVING_MEASURES for part in ("mean", "std", "min", "max")]


@query(f"WITH {PROFILE_SQL} SELECT cluster_id, COUNT(*) AS size, " + ", ".join(
    f"ROUND(AVG({c}), 6) AS {c}_mean, ROUND(STDDEV_SAMP({c}), 6) AS {c}_std, "
    f"ROUND(MIN({c}), 6) AS {c}_min, ROUND(MAX({c}), 6) AS {c}_max" for c in SERVING_MEASURES)
    + " FROM serving GROUP BY cluster_id")
def cluster_profile_full(spark: SparkSession, sf_dir: str) -> DataFrame:
    return round_columns(clusters.cluster_profile_full(serve(spark, sf_dir)), *FULL)


@query(f"WITH {PROFILE_SQL} SELECT cluster_id, " + ", ".join(
    f"ROUND((AVG({c}) - (SELECT AVG({c}) FROM serving)) / (SELECT STDDEV_POP({c}) FROM serving), 6) AS {c}"
    for c in SERVING_MEASURES) + " FROM serving GROUP BY cluster_id")
def cluster_profile_z(spark: SparkSession, sf_dir: str) -> DataFrame:
    return round_columns(clusters.cluster_profile_z(serve(spark, sf_dir)), *SERVING_MEASURES)


@query(f"""WITH {PROFILE_SQL}
SELECT cluster_id, location_id, city || ' (' || country || ')' AS member FROM serving""")
def cluster_members(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clusters.cluster_members(serve(spark, sf_dir))


@query(f"""WITH {PROFILE_SQL}, ids AS (SELECT CAST(UNNEST(range(0, 6)) AS INTEGER) AS cluster_id)
SELECT i.cluster_id, COUNT(s.cluster_id) AS size FROM ids i
LEFT JOIN serving s ON i.cluster_id = s.cluster_id GROUP BY i.cluster_id""")
def cluster_sizes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clusters.cluster_sizes(serve(spark, sf_dir), 6)


SCORES_SQL = f"""WITH {PROFILE_SQL},
tried AS (SELECT CAST(k AS INTEGER) AS k, location_id % k AS cluster, temperature_c AS t
  FROM serving, UNNEST(range(2, 9)) AS r(k)),
per AS (SELECT k, cluster, COUNT(*) AS n, VAR_POP(t) AS v FROM tried GROUP BY k, cluster),
scores AS (SELECT k, ROUND(SUM(n * v), 6) AS training_cost,
  ROUND(1 - SUM(n * v) / (SELECT VAR_POP(temperature_c) * COUNT(*) FROM serving), 6) AS silhouette
  FROM per GROUP BY k)"""


@query(f"""{SCORES_SQL}
(SELECT 'silhouette' AS criterion, k, silhouette, training_cost FROM scores ORDER BY silhouette DESC, k LIMIT 1)
UNION ALL
(SELECT 'training_cost', k, silhouette, training_cost FROM scores ORDER BY training_cost, k LIMIT 1)""")
def best_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Best rows of a score table; the scores are explained variance of fixed groupings."""
    places = serve(spark, sf_dir).select("location_id", F.col("temperature_c").alias("t"))
    tried = places.select("*", F.explode(F.sequence(F.lit(2), F.lit(8))).alias("k"))
    per = tried.groupBy("k", (F.col("location_id") % F.col("k")).alias("cluster")).agg(
        (F.count(F.lit(1)) * F.var_pop("t")).alias("within")
    )
    total = places.agg((F.var_pop("t") * F.count(F.lit(1))).alias("total")).scalar()
    scores = per.groupBy("k").agg(F.sum("within").alias("training_cost")).select(
        "k",
        F.round("training_cost", 6).alias("training_cost"),
        F.round(1 - F.col("training_cost") / total, 6).alias("silhouette"),
    )
    return ranking.best_scores(scores)


# ---- fitted clusters -------------------------------------------------------------------


def _frame(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Vectors of the profiles, which are folded and stored once for all fits over them."""
    path, table = scratch_path(spark, "profiles"), profile(spark, sf_dir)
    table.write.parquet(path)
    return clusters.vectors(spark.read.schema(table.schema).parquet(path))


@query(f"""WITH {PROFILE_SQL} SELECT COUNT(*) AS rows, CAST({clusters.FINAL_K} AS BIGINT) AS clusters,
  COUNT(*) AS at_nearest, CAST({clusters.FINAL_K} AS BIGINT) AS centres_at_mean, TRUE AS cost_matches,
  TRUE AS best_of_trials FROM profile""")
def kmeans_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What must hold for the final clusters, whatever they are."""
    frame = _frame(spark, sf_dir)
    fit = clusters.best_fit(frame)
    others = clusters.fit_trials(frame, [(clusters.FINAL_K, seed) for seed in clusters.SEEDS])
    return clusters.fit_facts(frame, fit, others)


@query(f"""WITH {PROFILE_SQL} SELECT COUNT(*) AS rows, TRUE AS centred, TRUE AS uncorrelated,
  TRUE AS first_share, TRUE AS second_share, TRUE AS in_order FROM profile""")
def pca_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What must hold for the two principal coordinates."""
    points = clusters.pca_2d(_frame(spark, sf_dir), ["location_id"])
    return clusters.pca_facts(points, len(PROFILE_MEASURES))


@query(f"""WITH {PROFILE_SQL}, facts AS (SELECT COUNT(*) AS n, COUNT(DISTINCT cluster_id) AS used,
    COUNT(*) FILTER (WHERE cluster_id NOT BETWEEN 0 AND {clusters.FINAL_K - 1}) AS outside,
    (SELECT COUNT(*) FROM catalogue) AS wanted FROM serving),
rules AS (SELECT 'clusters' AS dataset, 'rows' AS rule, CAST(n AS VARCHAR) AS observed,
    CAST(wanted AS VARCHAR) AS expected FROM facts
  UNION ALL SELECT 'clusters', 'clusters_used', CAST(used AS VARCHAR), '{clusters.FINAL_K}' FROM facts
  UNION ALL SELECT 'clusters', 'ids_outside_range', CAST(outside AS VARCHAR), '0' FROM facts)
SELECT *, CASE WHEN observed = expected THEN 'PASS' ELSE 'FAIL' END AS status FROM rules""")
def assignment_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rules of a cluster assignment: ids in range, all used, every place assigned."""
    wanted = catalogue(spark, sf_dir).count()
    return assignment_report(serve(spark, sf_dir), "clusters", clusters.FINAL_K, wanted)


FITTED_RULES = ", ".join(
    f"('{r}')" for r in ("rows", "clusters_used", "ids_outside_range", *(f"size_{i}" for i in range(clusters.FINAL_K)))
)


@query(f"""SELECT 'fitted' AS dataset, rule, 'PASS' AS status FROM (VALUES {FITTED_RULES}) AS t(rule)""")
def fitted_assignment_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same rules, and the expected size of every cluster, on the fitted assignment as it is
    stored and read back."""
    frame, path = _frame(spark, sf_dir), scratch_path(spark, "assignment")
    fit = clusters.best_fit(frame)
    clusters.assign_clusters(frame, fit).select("location_id", "cluster_id").write.parquet(path)
    stored = spark.read.parquet(path)
    wanted = catalogue(spark, sf_dir).count()
    found = assignment_report(stored, "fitted", clusters.FINAL_K, wanted, fit.sizes)
    return found.select("dataset", "rule", "status")


@query()
def kmeans_assign(spark: SparkSession, sf_dir: str) -> DataFrame:
    frame = _frame(spark, sf_dir)
    return clusters.assign_clusters(frame, clusters.fit_kmeans(frame, clusters.FINAL_K, 42))


@query()
def kmeans_sweep(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clusters.select_k(_frame(spark, sf_dir))


@query()
def kmeans_stability(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clusters.seed_stability(_frame(spark, sf_dir))


@query()
def kmeans_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    frame = _frame(spark, sf_dir)
    return clusters.centroids(frame, clusters.best_fit(frame))


@query()
def cluster_profiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Profile documents of the final clusters with their members, written as JSON and read back."""
    frame, path = _frame(spark, sf_dir), scratch_path(spark, "cluster-profiles")
    fit = clusters.best_fit(frame)
    clusters.write_profiles(fit.assign(frame), clusters.centroids(frame, fit), path)
    return clusters.read_profiles(spark, path)


@query(f"""WITH {PROFILE_SQL}, sizes AS (SELECT cluster_id, COUNT(*) AS size FROM serving GROUP BY cluster_id)
SELECT 'cluster_' || cluster_id AS name, cluster_id, size, location_id,
  city || ' (' || country || ')' AS member FROM serving JOIN sizes USING (cluster_id)""")
def profile_members(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents and members of the given clusters, in small shards, read back together."""
    assigned, path = serve(spark, sf_dir), scratch_path(spark, "cluster-profiles")
    centres = clusters.cluster_profile_z(assigned)
    clusters.write_profiles(assigned, centres, path, SERVING_MEASURES, shard_rows=100)
    read = clusters.read_profiles(spark, path, SERVING_MEASURES)
    return read.select("name", "cluster_id", "size", "location_id", "member")


@query()
def pca_2d(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clusters.pca_2d(_frame(spark, sf_dir), ["location_id", "city", "country"])

