from __future__ import annotations

import random

import numpy as np
import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from obsgrid.operators import clusters, neighbours, similarity
from obsgrid.schema import PROFILE_MEASURES, SERVING_MEASURES


@pytest.fixture(scope="module")
def profiles(spark):
    rng = random.Random(3)
    centres = [(0, 0, 0, 0, 0), (9, 1, 5, 2, 4), (2, 9, 1, 7, 3)]
    rows = [
        (i, f"City {i:03d}", f"Land {i % 5}", *[c + rng.gauss(0, 0.4) for c in centres[i % 3]])
        for i in range(90)
    ]
    fields = ", ".join(f"{m} double" for m in PROFILE_MEASURES)
    return spark.createDataFrame(rows, f"location_id long, city string, country string, {fields}")


def test_assignments_do_not_follow_the_input_layout(spark, profiles):
    seen = set()
    for layout in (profiles, profiles.repartition(5), profiles.orderBy(F.col("city").desc()).coalesce(1)):
        frame = clusters.vectors(layout)
        fit = clusters.fit_kmeans(frame, 3, 42)
        rows = clusters.assign_clusters(frame, fit).select("location_id", "cluster_id").collect()
        seen.add((round(fit.cost, 9), tuple(sorted((r[0], r[1]) for r in rows))))
    assert len(seen) == 1


def test_members_are_nearest_to_their_centre_and_scores_add_up(spark, profiles):
    frame = clusters.vectors(profiles)
    fit = clusters.best_fit(frame, k=3, seeds=(42, 100))
    centres = np.array(fit.centres())
    assert list(centres[:, 0]) == sorted(centres[:, 0])
    rows = fit.assign(frame).select("cluster_id", vector_to_array("features").alias("v")).collect()
    for r in rows:
        distances = ((centres - np.array(r["v"])) ** 2).sum(axis=1)
        assert distances.argmin() == r["cluster_id"]
    sizes = clusters.cluster_sizes(fit.assign(frame), 4).orderBy("cluster_id").collect()
    assert [r["size"] for r in sizes] == [30, 30, 30, 0]


def test_model_selection_finds_the_planted_groups(spark, profiles):
    scores = clusters.select_k(clusters.vectors(profiles), ks=(2, 3, 4)).collect()
    by_k = {r["k"]: r for r in scores}
    assert max(scores, key=lambda r: r["silhouette"])["k"] == 3
    assert by_k[3]["cluster_sizes"] == [30, 30, 30]
    assert all(sum(r["cluster_sizes"]) == 90 for r in scores)
    assert by_k[2]["training_cost"] > by_k[3]["training_cost"]


def test_pca_matches_the_covariance(spark, profiles):
    frame = clusters.vectors(profiles)
    got = clusters.pca_2d(frame, ["location_id"]).orderBy("location_id").collect()
    x = np.array([[r[m] for m in PROFILE_MEASURES] for r in profiles.orderBy("location_id").collect()])
    z = (x - x.mean(0)) / x.std(0, ddof=1)
    values, basis = np.linalg.eigh(np.cov(z.T))
    for j, name in ((-1, "pc1"), (-2, "pc2")):
        direction = basis[:, j] * np.sign(basis[np.abs(basis[:, j]).argmax(), j])
        assert [r[name] for r in got] == pytest.approx(list(z @ direction), abs=1e-8)
    assert got[0]["explained_1"] == pytest.approx(values[-1] / values.sum())


def serving(spark, n=60, seed=4):
    rng = random.Random(seed)
    rows = [
        (i, f"City {i:03d}", f"Land {i % 7}", i % 4, *[rng.uniform(0, 50) for _ in SERVING_MEASURES])
        for i in range(n)
    ]
    fields = ", ".join(f"{m} double" for m in SERVING_MEASURES)
    return spark.createDataFrame(
        rows, f"location_id long, city string, country string, cluster_id int, {fields}"
    )


def _z(df):
    x = np.array([[r[m] for m in SERVING_MEASURES] for r in df.orderBy("location_id").collect()])
    return (x - x.mean(0)) / x.std(0)


def test_nearest_equals_brute_force(spark):
    df = serving(spark)
    z = _z(df)
    got = similarity.nearest_to(similarity.standardise(df, SERVING_MEASURES), "City 007", n=6).collect()
    distances = np.sqrt(((z - z[7]) ** 2).sum(1))
    wanted = [i for i in np.argsort(distances) if i != 7][:6]
    assert [r["city"] for r in got] == [f"City {i:03d}" for i in wanted]
    assert [r["distance"] for r in got] == pytest.approx([distances[i] for i in wanted])


def test_pair_distance_and_shares(spark):
    df = serving(spark)
    z = _z(df)
    table = similarity.standardise(df, SERVING_MEASURES)
    pair = similarity.pair_distance(table, "City 001", "City 005").first()
    assert pair["same_cluster"] is True
    assert pair["standardized_distance"] == pytest.approx(np.linalg.norm(z[1] - z[5]))
    shares = similarity.distance_contributions(table, "City 001", "City 005").collect()
    assert sum(r["distance_contribution"] for r in shares) == pytest.approx(1.0)
    assert shares == sorted(shares, key=lambda r: -r["distance_contribution"])


def test_identical_profiles_have_zero_shares(spark):
    df = serving(spark, 5)
    twin = df.where("location_id = 1").withColumns({"location_id": F.lit(9).cast("long"), "city": F.lit("Twin")})
    table = similarity.standardise(df.unionByName(twin), SERVING_MEASURES)
    shares = similarity.distance_contributions(table, "City 001", "Twin").collect()
    assert [r["distance_contribution"] for r in shares] == [0.0] * 5


def test_pair_errors(spark):
    table = similarity.standardise(serving(spark, 8), SERVING_MEASURES)
    with pytest.raises(ValueError):
        similarity.pair_compare(table, "City 001", "City 001")
    with pytest.raises(Exception, match="expected one record for Nowhere, found 0"):
        similarity.pair_compare(table, "City 001", "Nowhere").collect()
    doubled = table.unionByName(table.where("location_id = 2"))
    with pytest.raises(Exception, match="expected one record for City 002, found 2"):
        similarity.pair_compare(doubled, "City 001", "City 002").collect()
    with pytest.raises(Exception, match="expected one record for Nowhere, found 0"):
        similarity.nearest_to(table, "Nowhere").collect()


def test_zero_variance_is_named(spark):
    flat = serving(spark, 6).withColumn("humidity_percent", F.lit(1.0))
    with pytest.raises(Exception, match="zero variance: humidity_percent"):
        similarity.standardise(flat, SERVING_MEASURES).collect()


@pytest.mark.parametrize("cell_rows", [4096, 32, 8, 4])
def test_nearest_of_all_equals_brute_force(spark, cell_rows):
    """A third of the places are copies, the rest are spread unevenly, some on one line."""
    rng = random.Random(11)
    points = [(1.0, 1.0, 1.0)] * 120
    points += [(rng.gauss(0, 1), rng.gauss(0, 1), rng.gauss(0, 1)) for _ in range(150)]
    points += [(rng.gauss(50, 0.01), rng.gauss(0, 20), 3.0) for _ in range(80)]
    points += [(rng.uniform(-500, 500), 0.0, 0.0) for _ in range(10)]
    rows = [(i, f"City {i:03d}", *p) for i, p in enumerate(points)]
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, "location_id long, city string, a double, b double, c double")
    got = neighbours.nearest_all(df, ["a", "b", "c"], n=4, cell_rows=cell_rows).collect()
    found = {}
    for r in got:
        found.setdefault(r["location_id"], {})[r["rank"]] = (r["neighbour_id"], r["distance"])
    x = np.array(points)
    assert len(found) == len(points)
    for i in range(len(points)):
        total = np.zeros(len(points))
        for d in range(3):
            total += (x[i, d] - x[:, d]) * (x[i, d] - x[:, d])
        distance = np.sqrt(total)
        wanted = [j for j in np.lexsort((np.arange(len(points)), distance)) if j != i][:4]
        assert [found[i][k + 1][0] for k in range(4)] == wanted
        assert [found[i][k + 1][1] for k in range(4)] == [distance[j] for j in wanted]


def test_centres_follow_the_rows_and_not_their_layout(spark):
    rng = random.Random(4)
    rows = [(i, *(rng.gauss(4 * (i % 3), 1.0) for _ in range(5))) for i in range(700)]
    fields = "location_id long, " + ", ".join(f"{m} double" for m in clusters.PROFILE_MEASURES)
    profiles = spark.createDataFrame(rows, fields)
    trials = [(2, 42), (3, 42), (3, 7), (5, 100)]
    few, many = (clusters.fit_trials(clusters.vectors(profiles.repartition(n)), trials) for n in (3, 50))
    for a, b in zip(few, many):
        assert a.sizes == b.sizes and a.cost == pytest.approx(b.cost)
        assert np.allclose(a.found, b.found, rtol=0, atol=1e-9)
    # Every fit is a fixed point: centres at the means of their members, found here in numpy.
    frame = clusters.vectors(profiles)
    points = np.array([r["features"].toArray() for r in frame.orderBy("location_id").collect()])
    for fit in few:
        centres = np.array(fit.found)
        gaps = ((points[:, None, :] - centres[None]) ** 2).sum(axis=2)
        near = gaps.argmin(axis=1)
        assert np.bincount(near, minlength=fit.k).tolist() == list(fit.sizes)
        assert gaps.min(axis=1).sum() == pytest.approx(fit.cost, rel=1e-5)
        means = np.array([points[near == c].mean(axis=0) for c in range(fit.k)])
        assert np.abs(means - centres).max() < 1e-3
    assert few[1].sizes == few[2].sizes and sorted(few[1].sizes) == [233, 233, 234]


def test_fewer_points_than_clusters(spark):
    fields = "location_id long, " + ", ".join(f"{m} double" for m in clusters.PROFILE_MEASURES)
    rows = [(i, *(float(i % 2 + m) for m in range(5))) for i in range(6)]
    fit = clusters.fit_kmeans(clusters.vectors(spark.createDataFrame(rows, fields)), 4, 1)
    assert fit.sizes == (3, 3) and fit.cost == pytest.approx(0.0, abs=1e-6)


def test_cells_hold_no_more_than_asked(spark):
    rng = random.Random(2)
    points = {(float(rng.randint(0, 3)), float(rng.randint(0, 2)), rng.random()) for _ in range(600)}
    points |= {(7.0, 7.0, i / 7) for i in range(100)}
    df = spark.createDataFrame([list(p) for p in points], "x0 double, x1 double, x2 double")
    cuts = neighbours.place_cuts(df, ["x0", "x1", "x2"], 8)
    counts = np.bincount(cuts.cells(np.array(sorted(points))))
    assert counts.max() <= 8 and counts.sum() == len(points)
