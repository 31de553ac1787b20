"""K-Means on standardised profiles, model selection, cluster profiles and PCA."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from multiprocessing.pool import ThreadPool

from pyspark.ml.evaluation import ClusteringEvaluator
from pyspark.ml.feature import PCA, StandardScaler, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import DenseVector
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.util import inheritable_thread_target

from obsgrid.functions.labels import member_label
from obsgrid.operators import kmeans
from obsgrid.schema import PROFILE_MEASURES, SERVING_MEASURES

PARALLEL_SCORES = 4
#: Members in one file of a cluster profile.
SHARD_ROWS = 100_000

# The tried settings.
MAX_ITERATIONS = 100
TOLERANCE = 1e-4
CANDIDATE_K = tuple(range(2, 9))
FINAL_K = 4
SEEDS = (42, 100, 2024, 777, 999)


def vectors(profiles: DataFrame, columns: Sequence[str] = PROFILE_MEASURES) -> DataFrame:
    """Assembled and standardised (sample deviation) vectors."""
    assembled = VectorAssembler(
        inputCols=list(columns), outputCol="raw", handleInvalid="error"
    ).transform(profiles)
    scaler = StandardScaler(inputCol="raw", outputCol="features", withMean=True, withStd=True)
    return scaler.fit(assembled).transform(assembled)


@dataclass(frozen=True)
class Fit:
    """Centres of the clusters, whose ids 0..k-1 follow the centres' first coordinate, not the
    order of discovery."""

    k: int
    seed: int
    cost: float
    sizes: tuple[int, ...]
    found: tuple[tuple[float, ...], ...]

    def assign(self, frame: DataFrame) -> DataFrame:
        point = vector_to_array("features")
        gaps = [
            F.struct(
                sum((point[i] - F.lit(v)) * (point[i] - F.lit(v)) for i, v in enumerate(centre)).alias("gap"),
                F.lit(number).alias("id"),
            )
            for number, centre in enumerate(self.found)
        ]
        return frame.withColumn("cluster_id", F.array_min(F.array(*gaps))["id"])

    def centres(self) -> list[list[float]]:
        return [list(c) for c in self.found]


def fit_trials(
    frame: DataFrame, trials: Sequence[tuple[int, int]], key: str = "location_id"
) -> list[Fit]:
    """Fits of all (k, seed), found together; the same for any layout of the rows."""
    width = frame.schema["features"].metadata.get("ml_attr", {}).get("num_attrs")
    width = width or len(frame.select("features").first()["features"])
    found = kmeans.fit(
        frame, key, vector_to_array("features"), width, trials, MAX_ITERATIONS, TOLERANCE
    )
    return [
        Fit(t.k, t.seed, t.cost, t.sizes, tuple(tuple(map(float, c)) for c in t.centres))
        for t in found
    ]


def fit_kmeans(frame: DataFrame, k: int, seed: int) -> Fit:
    return fit_trials(frame, [(k, seed)])[0]


def silhouette(assigned: DataFrame) -> float:
    return ClusteringEvaluator(
        featuresCol="features", predictionCol="cluster_id", distanceMeasure="squaredEuclidean"
    ).evaluate(assigned)


def _score(frame: DataFrame, fit: Fit) -> tuple:
    sizes = list(fit.sizes)
    score = float(silhouette(fit.assign(frame)))
    return (fit.k, fit.seed, fit.cost, score, min(sizes), max(sizes), sizes)


SCORE_SCHEMA = (
    "k int, seed long, training_cost double, silhouette double, "
    "min_cluster_size long, max_cluster_size long, cluster_sizes array<long>"
)


def _each(spark: SparkSession, trial: Callable, settings: Sequence) -> list:
    """Independent short jobs side by side. Results keep the order of the settings."""
    with ThreadPool(min(PARALLEL_SCORES, len(settings))) as pool:
        return pool.map(inheritable_thread_target(spark)(trial), settings)


def sweep(frame: DataFrame, trials: Sequence[tuple[int, int]]) -> DataFrame:
    """Scores of (k, seed) trials over one cached frame; only the score rows reach the driver."""
    frame = frame.persist()
    try:
        frame.count()
        fits = fit_trials(frame, trials)
        rows = _each(frame.sparkSession, lambda fit: _score(frame, fit), fits)
    finally:
        frame.unpersist()
    return frame.sparkSession.createDataFrame(rows, SCORE_SCHEMA)


def select_k(frame: DataFrame, ks: Sequence[int] = CANDIDATE_K, seed: int = 42) -> DataFrame:
    return sweep(frame, [(k, seed) for k in ks])


def seed_stability(
    frame: DataFrame, k: int = FINAL_K, seeds: Sequence[int] = SEEDS
) -> DataFrame:
    return sweep(frame, [(k, seed) for seed in seeds])


def best_fit(frame: DataFrame, k: int = FINAL_K, seeds: Sequence[int] = SEEDS) -> Fit:
    """Best silhouette over the seeds; equal scores go to the seed tried first."""
    frame = frame.persist()
    try:
        frame.count()
        spark = frame.sparkSession
        fits = fit_trials(frame, [(k, seed) for seed in seeds])
        scores = _each(spark, lambda fit: silhouette(fit.assign(frame)), fits)
    finally:
        frame.unpersist()
    return fits[max(range(len(fits)), key=scores.__getitem__)]


def assign_clusters(frame: DataFrame, fit: Fit) -> DataFrame:
    return fit.assign(frame).drop("raw", "features")


def centroids(frame: DataFrame, fit: Fit, columns: Sequence[str] = PROFILE_MEASURES) -> DataFrame:
    """Centres in standardised units, one row per cluster."""
    rows = [(i, *centre) for i, centre in enumerate(fit.centres())]
    fields = ", ".join(f"{c} double" for c in columns)
    return frame.sparkSession.createDataFrame(rows, f"cluster_id int, {fields}")


def cluster_sizes(assigned: DataFrame, k: int) -> DataFrame:
    """Members of every id 0..k-1, zero where a cluster is empty."""
    ids = assigned.sparkSession.range(k).select(F.col("id").cast("int").alias("cluster_id"))
    counted = assigned.groupBy("cluster_id").agg(F.count(F.lit(1)).alias("n"))
    return ids.join(counted, "cluster_id", "left").select(
        "cluster_id", F.coalesce("n", F.lit(0)).alias("size")
    )


def cluster_profile(
    assigned: DataFrame, columns: Sequence[str] = SERVING_MEASURES
) -> DataFrame:
    """Size and mean of every variable per cluster, in original units."""
    return assigned.groupBy("cluster_id").agg(
        F.count(F.lit(1)).alias("locations"), *[F.avg(c).alias(c) for c in columns]
    )


def cluster_profile_full(
    assigned: DataFrame, columns: Sequence[str] = SERVING_MEASURES
) -> DataFrame:
    """Mean, sample deviation and extremes per cluster; one member has no deviation."""
    aggregates = []
    for c in columns:
        aggregates += [
            F.avg(c).alias(f"{c}_mean"),
            F.stddev_samp(c).alias(f"{c}_std"),
            F.min(c).alias(f"{c}_min"),
            F.max(c).alias(f"{c}_max"),
        ]
    return assigned.groupBy("cluster_id").agg(F.count(F.lit(1)).alias("size"), *aggregates)


def cluster_profile_z(
    assigned: DataFrame, columns: Sequence[str] = SERVING_MEASURES
) -> DataFrame:
    """Cluster means in population deviations from the global mean."""
    stats = assigned.agg(
        F.struct(
            *[F.avg(c).alias(f"{c}_mean") for c in columns],
            *[F.stddev_pop(c).alias(f"{c}_dev") for c in columns],
        ).alias("stats")
    ).scalar()
    means = cluster_profile(assigned, columns).withColumn("_s", stats)
    return means.select(
        "cluster_id",
        *[
            ((F.col(c) - F.col(f"_s.{c}_mean")) / F.col(f"_s.{c}_dev")).alias(c) for c in columns
        ],
    )


def cluster_members(assigned: DataFrame) -> DataFrame:
    """Every member as "City (Country)", one row each.

    Kept as rows: a cluster may hold a large share of all places, and a list of them would
    have to fit in one cell.
    """
    return assigned.select(
        "cluster_id",
        "location_id",
        member_label(F.col("city"), F.col("country")).alias("member"),
    )


def cluster_documents(
    assigned: DataFrame, fit_centres: DataFrame, columns: Sequence[str] = PROFILE_MEASURES
) -> DataFrame:
    """One profile document per cluster: size, standardised centre and mean per variable."""
    profile = cluster_profile(assigned, columns).select(
        "cluster_id",
        F.col("locations").alias("size"),
        F.struct(*columns).alias("original_unit_means"),
    )
    centres = fit_centres.select(
        "cluster_id", F.struct(*columns).alias("standardized_centroids")
    )
    return profile.join(centres, "cluster_id").select(
        F.concat(F.lit("cluster_"), F.col("cluster_id")).alias("name"),
        "cluster_id",
        "size",
        "standardized_centroids",
        "original_unit_means",
    )


def write_profiles(
    assigned: DataFrame,
    fit_centres: DataFrame,
    root: str,
    columns: Sequence[str] = PROFILE_MEASURES,
    shard_rows: int = SHARD_ROWS,
) -> None:
    """The clusters' documents, and their members beside them in shards of at most ``shard_rows``
    rows. A list inside a document would hold a large share of all places in one cell."""
    documents = cluster_documents(assigned, fit_centres, columns)
    documents.coalesce(1).write.mode("overwrite").json(f"{root}/documents")
    (
        cluster_members(assigned)
        .write.mode("overwrite")
        .option("maxRecordsPerFile", shard_rows)
        .partitionBy("cluster_id")
        .json(f"{root}/members")
    )


def read_profiles(
    spark: SparkSession, root: str, columns: Sequence[str] = PROFILE_MEASURES
) -> DataFrame:
    """One row per member with its cluster's document: shards are read whole, documents are as
    many as clusters."""
    values = "struct<" + ", ".join(f"{c}: double" for c in columns) + ">"
    documents = spark.read.schema(
        f"name string, cluster_id int, size long, standardized_centroids {values}, "
        f"original_unit_means {values}"
    ).json(f"{root}/documents")
    members = spark.read.schema("location_id long, member string, cluster_id int").json(f"{root}/members")
    return documents.join(members, "cluster_id")


def pca_2d(frame: DataFrame, keys: Sequence[str], features: str = "features") -> DataFrame:
    """Two principal coordinates with the variance each explains.

    A component's sign is arbitrary; it is turned so that its largest loading is positive.
    """
    model = PCA(k=2, inputCol=features, outputCol="pca").fit(frame)
    loadings = model.pc.toArray()
    signs = [1.0 if loadings[abs(loadings[:, j]).argmax(), j] > 0 else -1.0 for j in range(2)]
    explained: DenseVector = model.explainedVariance
    point = vector_to_array("pca")
    return model.transform(frame).select(
        *keys,
        (point[0] * signs[0]).alias("pc1"),
        (point[1] * signs[1]).alias("pc2"),
        F.lit(float(explained[0])).alias("explained_1"),
        F.lit(float(explained[1])).alias("explained_2"),
    )


def fit_facts(frame: DataFrame, fit: Fit, others: Sequence[Fit] = ()) -> DataFrame:
    """What must hold for a fit, as one row of numbers: members at their nearest centre, centres
    at their members' mean, the cost as the sum of squared distances, the best of its trials."""
    centres = fit.centres()
    points = fit.assign(frame).select("cluster_id", vector_to_array("features").alias("x"))
    squares = [
        sum((F.col("x")[i] - F.lit(v)) * (F.col("x")[i] - F.lit(v)) for i, v in enumerate(centre))
        for centre in centres
    ]
    measured = points.withColumn("d", F.array(*squares)).withColumn(
        "own", F.get("d", F.col("cluster_id"))
    )
    width = len(centres[0])
    per = measured.groupBy("cluster_id").agg(
        F.count(F.lit(1)).alias("size"),
        F.count_if(F.col("own") <= F.array_min("d") + 1e-9).alias("nearest"),
        F.sum("own").alias("cost"),
        F.array(*[F.avg(F.col("x")[i]) for i in range(width)]).alias("mean"),
    )
    table = F.array(*[F.array(*[F.lit(v) for v in centre]) for centre in centres])
    gaps = F.transform(
        F.arrays_zip("mean", F.get(table, F.col("cluster_id")).alias("centre")),
        lambda p: F.abs(p["mean"] - p["centre"]),
    )
    scores = [silhouette(f.assign(frame)) for f in (fit, *others)]
    return per.withColumn("gap", F.array_max(gaps)).agg(
        F.sum("size").alias("rows"),
        F.count(F.lit(1)).alias("clusters"),
        F.sum("nearest").alias("at_nearest"),
        F.count_if(F.col("gap") <= 10 * TOLERANCE).alias("centres_at_mean"),
        (F.abs(F.sum("cost") - F.lit(fit.cost)) <= 1e-6 * F.sum("cost") + 1e-9).alias("cost_matches"),
        F.lit(scores[0] >= max(scores)).alias("best_of_trials"),
    )


def pca_facts(points: DataFrame, variables: int) -> DataFrame:
    """What must hold for two principal coordinates of standardised columns: centred,
    uncorrelated, in order, and each with the variance it claims to explain."""
    share = lambda i: F.var_samp(f"pc{i}") / variables
    return points.agg(
        F.count(F.lit(1)).alias("rows"),
        (F.greatest(F.abs(F.avg("pc1")), F.abs(F.avg("pc2"))) < 1e-9).alias("centred"),
        (F.abs(F.covar_samp("pc1", "pc2")) < 1e-9).alias("uncorrelated"),
        (F.abs(share(1) - F.max("explained_1")) < 1e-9).alias("first_share"),
        (F.abs(share(2) - F.max("explained_2")) < 1e-9).alias("second_share"),
        (F.max("explained_1") >= F.max("explained_2")).alias("in_order"),
    )
