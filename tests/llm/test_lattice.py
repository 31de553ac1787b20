from __future__ import annotations

import numpy as np
import pytest
from llm_helpers import by_id, reachable, unit

from obsgrid.llm import lattice
from obsgrid.llm.queries import QUERIES

SCHEMA = "vec_id long, embedding array<double>, label int, v string, unit long"


def vectors(spark, rows):
    return spark.createDataFrame([(i, x, 0, None, None) for i, x in rows], SCHEMA)


def brute(ids, x, threshold=0.9):
    u = unit(np.asarray(x, float))
    near = (u @ u.T >= threshold) & ~np.eye(len(u), dtype=bool)
    groups = reachable(set(ids), [(ids[a], ids[b]) for a, b in zip(*np.nonzero(near))])
    return {i: (int(near[k].sum()), groups[i], groups[i] == i) for k, i in enumerate(ids)}


def plain(df):
    return {i: (r["n_links"], r["component_id"], r["kept"]) for i, r in by_id(df, "vec_id").items()}


def test_nearest_points():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(200, 8)) * 2
    points = lattice.nearest_e8(x)
    doubled = np.rint(points * 2)
    assert np.allclose(points * 2, doubled) and (doubled % 2 == doubled[:, :1] % 2).all()
    assert (points.sum(axis=1) % 2 == 0).all()
    roots = lattice._roots()
    assert len(roots) == 240 and np.allclose((roots**2).sum(axis=1), 2)
    own = ((x - points) ** 2).sum(axis=1)
    others = ((x[:, None] - points[:, None] - roots[None]) ** 2).sum(axis=2).min(axis=1)
    assert (own <= others + 1e-9).all()


def test_query(spark, sf_dir):
    rows = spark.read.parquet(f"{sf_dir}/embeddings.parquet").collect()
    got = plain(QUERIES["op10_lattice"](spark, sf_dir))
    assert got == brute([r["vec_id"] for r in rows], [r["embedding"] for r in rows])


def test_recall_at_the_threshold(spark):
    """Pairs at cosines just above 0.9, the hardest ones, among random vectors."""
    rng = np.random.default_rng(1)
    n, d = 1500, 64
    x = unit(rng.normal(size=(n, d)))
    z = unit(rng.normal(size=(n, d)))
    z = unit(z - (z * x).sum(axis=1, keepdims=True) * x)
    cos = np.linspace(0.901, 0.95, n)[:, None]
    both = np.concatenate([x, cos * x + np.sqrt(1 - cos**2) * z])
    want = brute(list(range(2 * n)), both)
    got = plain(lattice.near_duplicates(vectors(spark, list(enumerate(both.tolist())))))
    assert all(got[i][0] <= want[i][0] for i in want)
    assert sum(g[0] for g in got.values()) >= 0.9 * sum(w[0] for w in want.values())


@pytest.mark.parametrize("noise", [0.01, 0.12, 0.35])
def test_crowds_are_counted_in_full(spark, noise):
    """Near copies so tight that units hold them all, and so wide that units lie on the edge."""
    rng = np.random.default_rng(2)
    centres = unit(rng.normal(size=(3, 64)))
    x = np.concatenate([unit(c + noise * unit(rng.normal(size=(150, 64)))) for c in centres] + [unit(rng.normal(size=(100, 64)))])
    ids = [int(i) for i in rng.permutation(1000)[: len(x)]]
    got = plain(lattice.near_duplicates(vectors(spark, list(zip(ids, x.tolist())))))
    want = brute(ids, x)
    if noise < 0.3:
        assert got == want
    assert all(got[i][0] <= want[i][0] for i in ids)
    assert sum(g[0] for g in got.values()) >= 0.9 * sum(w[0] for w in want.values())


def test_awkward_vectors(spark):
    a, b = [1.0, 2.0, 3.0], [1e-200, 2e-200, 3e-200]
    rows = [
        (1, None), (2, []), (3, [0.0, 0.0, 0.0]), (4, [1.0, None, 2.0]), (5, [float("nan"), 1.0, 1.0]),
        (6, [float("inf"), 1.0, 1.0]), (10, a), (11, b), (12, a), (12, a), (13, [1.0, 2.0]), (14, [-1.0, -2.0, -3.0]),
        (None, a), (9, [1e300, 2e300, 3e300]),
    ]
    got = plain(lattice.near_duplicates(vectors(spark, rows)))
    alone = {i: (0, i, True) for i in (1, 2, 3, 4, 5, 6, 13, 14)}
    linked = {i: (3, 9, i == 9) for i in (9, 10, 11, 12)}
    assert got == alone | linked
    assert lattice.near_duplicates(vectors(spark, [])).count() == 0
