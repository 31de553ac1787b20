"""Near duplicates of embeddings by lattice hashing.

A table projects unit vectors at random into a few blocks of eight dimensions and decodes each
block to its nearest point of the E8 lattice; the points together are the vector's cell. In
several such tables every vector looks up its own cell and the ``PROBES`` neighbouring cells that
lie nearest to it, and the cosine of every candidate is verified in double precision.

Vectors that crowd together are folded first: in each cell of a table the smallest id leads, and
all vectors within half the link's angle of it form its unit, since any two of them link. Units
are looked up by their leaders, and by the triangle inequality on angles a pair of units, or a
vector and a unit, mostly links as a whole or not at all; only what lies on the edge is compared
vector by vector. So a crowd of near copies costs its units' pairs, not its own, and no link is
lost or capped.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from obsgrid.llm.common import table, written
from obsgrid.llm.components import components
from obsgrid.llm.registry import query

COSINE = 0.9
TABLES = 12
BLOCKS = 3
#: Lattice units that a unit vector's expected length in a block is stretched to.
STRETCH = 1.2
PROBES = 8
#: Nearest neighbours of a block's point that are combined into neighbouring cells.
NEAREST = 4
#: Tables whose cells units are formed in, one after the other.
FOLDS = 2
SEED = 17
#: Angles nearer to a bound than this are not decided by it.
MARGIN = 1e-6


def _roots() -> np.ndarray:
    """The 240 shortest vectors of E8."""
    out = []
    for i, j in itertools.combinations(range(8), 2):
        for a, b in itertools.product((1.0, -1.0), repeat=2):
            v = np.zeros(8)
            v[i], v[j] = a, b
            out.append(v)
    out += [np.array(v) for v in itertools.product((0.5, -0.5), repeat=8) if np.prod(v) > 0]
    return np.array(out)


def _even(x: np.ndarray) -> np.ndarray:
    """Nearest integer points with an even sum."""
    near = np.rint(x)
    gap = x - near
    odd = np.flatnonzero(near.sum(axis=1) % 2)
    at = np.abs(gap[odd]).argmax(axis=1)
    near[odd, at] += np.where(gap[odd, at] >= 0, 1.0, -1.0)
    return near


def nearest_e8(x: np.ndarray) -> np.ndarray:
    """The lattice point nearest to each row: integers or half-integers with an even sum."""
    whole, half = _even(x), _even(x - 0.5) + 0.5
    nearer = ((x - whole) ** 2).sum(axis=1) <= ((x - half) ** 2).sum(axis=1)
    return np.where(nearer[:, None], whole, half)


def _key(points: np.ndarray, number: int) -> np.ndarray:
    """A 64-bit hash of lattice points (rows x blocks x 8) and their table."""
    doubled = np.rint(points * 2).astype(np.int64).reshape(len(points), -1).view(np.uint64)
    out = np.full(len(points), number + 1, np.uint64)
    for column in doubled.T:
        out = (out ^ column) * np.uint64(0x9E3779B97F4A7C15)
        out ^= out >> np.uint64(29)
    return out.view(np.int64)


def unit_rows(vectors: list) -> np.ndarray:
    """Rows of length one in double precision."""
    x = np.stack([np.asarray(v, np.float64) for v in vectors])
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def cells(x: np.ndarray, number: int, probes: int) -> np.ndarray:
    """Keys of unit vectors in a table: their own cell and then neighbouring ones."""
    rng = np.random.default_rng([SEED, number, x.shape[1]])
    directions = rng.normal(size=(x.shape[1], 8 * BLOCKS)) * (STRETCH / np.sqrt(8))
    y = (x @ directions + rng.uniform(size=8 * BLOCKS)).reshape(len(x), BLOCKS, 8)
    own = np.stack([nearest_e8(y[:, b]) for b in range(BLOCKS)], axis=1)
    keys = [_key(own, number)]
    if probes:
        roots = _roots()
        excess = np.zeros((len(x), BLOCKS, NEAREST + 1))
        points = np.repeat(own[:, :, None, :], NEAREST + 1, axis=2)
        for b in range(BLOCKS):
            # A neighbour's squared distance less the own point's.
            more = 2.0 - 2.0 * (y[:, b] - own[:, b]) @ roots.T
            best = np.argsort(more, axis=1, kind="stable")[:, :NEAREST]
            excess[:, b, 1:] = np.take_along_axis(more, best, axis=1)
            points[:, b, 1:] += roots[best]
        mixes = np.array(list(itertools.product(range(NEAREST + 1), repeat=BLOCKS))[1:])
        total = sum(excess[:, b, mixes[:, b]] for b in range(BLOCKS))
        rank = np.argsort(total, axis=1, kind="stable")[:, :probes]
        for r in range(rank.shape[1]):
            pick = mixes[rank[:, r]]
            moved = np.stack([points[np.arange(len(x)), b, pick[:, b]] for b in range(BLOCKS)], axis=1)
            keys.append(_key(moved, number))
    return np.stack(keys, axis=1)


def _by_length(vectors: pd.Series) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(positions, unit vectors) for each length of vector."""
    sizes = vectors.map(len).to_numpy()
    for size in np.unique(sizes):
        at = np.flatnonzero(sizes == size)
        yield at, unit_rows(vectors.iloc[at].tolist())


def _cell(number: int, vector: str) -> Column:
    @F.pandas_udf("long")
    def own(vectors: pd.Series) -> pd.Series:
        out = np.zeros(len(vectors), np.int64)
        for at, x in _by_length(vectors):
            out[at] = cells(x, number, 0)[:, 0]
        return pd.Series(out)

    return own(F.col(vector))


@F.pandas_udf(DoubleType())
def cosine(a: pd.Series, b: pd.Series) -> pd.Series:
    """In double precision; vectors of different lengths have none (-1)."""
    out = np.full(len(a), -1.0)
    size_a, size_b = a.map(len).to_numpy(), b.map(len).to_numpy()
    for size in np.unique(size_a[size_a == size_b]):
        at = np.flatnonzero((size_a == size) & (size_b == size))
        x, y = unit_rows(a.iloc[at].tolist()), unit_rows(b.iloc[at].tolist())
        out[at] = np.clip((x * y).sum(axis=1), -1.0, 1.0)
    return pd.Series(out)


def _lookups(units: DataFrame) -> DataFrame:
    """(unit, key, own): the cells of every unit's leader in all tables."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in batches:
            for at, x in _by_length(rows["v"]):
                ids = rows["unit"].to_numpy()[at]
                for number in range(TABLES):
                    keys = cells(x, number, PROBES)
                    yield pd.DataFrame(
                        {
                            "unit": np.repeat(ids, keys.shape[1]),
                            "key": keys.ravel(),
                            "own": np.tile(np.arange(keys.shape[1]) == 0, len(ids)),
                        }
                    )

    return units.select("unit", "v").mapInPandas(run, "unit long, key long, own boolean")


def _sound(vector: str) -> Column:
    """Whether a vector has a direction."""
    v = F.col(vector)
    bad = F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return F.coalesce((F.size(v) > 0) & ~bad & F.exists(v, lambda x: x != 0), F.lit(False))


def _units(vectors: DataFrame, core: float) -> DataFrame:
    """(vec_id, v, unit, angle): every vector with its leader and the angle to it."""
    rest, done = vectors, []
    for number in range(FOLDS):
        placed = written(rest.withColumn("cell", _cell(TABLES + number, "v")), "cells")
        leaders = placed.groupBy("cell").agg(F.min(F.struct("vec_id", "v")).alias("_first"))
        near = written(
            placed.join(leaders, "cell").select(
                "vec_id",
                "v",
                F.col("_first.vec_id").alias("unit"),
                F.when(F.col("vec_id") == F.col("_first.vec_id"), 0.0)
                .otherwise(F.acos(cosine("v", "_first.v")))
                .alias("angle"),
            ),
            "units",
        )
        done.append(near.where(F.col("angle") <= core))
        rest = near.where(F.col("angle") > core).select("vec_id", "v")
    done.append(rest.select("vec_id", "v", F.col("vec_id").alias("unit"), F.lit(0.0).alias("angle")))
    out = done[0]
    for more in done[1:]:
        out = out.union(more)
    return written(out, "members")


def near_duplicates(
    embeddings: DataFrame,
    vec_id: str = "vec_id",
    embedding: str = "embedding",
    threshold: float = COSINE,
) -> DataFrame:
    """(vec_id, n_links, component_id, kept) of every vector.

    Vectors that are null, empty or zero, or that hold null or non-finite components, link with
    nothing, as do vectors of different lengths. Rows without a vec_id are left out; of rows that
    repeat one, that with the smallest vector counts. An empty table gives no rows; other columns
    are not looked at.
    """
    rows = (
        embeddings.where(F.col(vec_id).isNotNull())
        .select(F.col(vec_id).cast("long").alias("vec_id"), F.col(embedding).alias("v"))
        .groupBy("vec_id")
        .agg(F.min("v").alias("v"))
    )
    rows = written(rows.withColumn("sound", _sound("v")), "vectors")
    limit = float(np.arccos(threshold))
    members = _units(rows.where("sound").select("vec_id", "v"), limit / 2 - MARGIN)
    units = written(
        members.groupBy("unit").agg(
            F.count(F.lit(1)).alias("weight"),
            F.max("angle").alias("radius"),
            F.min(F.when(F.col("vec_id") == F.col("unit"), F.col("v"))).alias("v"),
        ),
        "units",
    )
    lookups = written(_lookups(units), "lookups")
    owners = lookups.where("own").select(F.col("unit").alias("_owner"), "key")
    candidates = (
        lookups.join(owners, "key")
        .where(F.col("unit") != F.col("_owner"))
        .select(F.least("unit", "_owner").alias("a"), F.greatest("unit", "_owner").alias("b"))
        .distinct()
    )
    left = units.select(*[F.col(c).alias(f"a_{c}") for c in units.columns])
    right = units.select(*[F.col(c).alias(f"b_{c}") for c in units.columns])
    met = written(
        candidates.join(left, F.col("a") == F.col("a_unit"))
        .join(right, F.col("b") == F.col("b_unit"))
        .select(
            "a", "b", "a_weight", "b_weight", "a_radius", "b_radius", cosine("a_v", "b_v").alias("cos")
        )
        .withColumn("slack", F.col("a_radius") + F.col("b_radius"))
        .withColumn("angle", F.acos("cos"))
        .where(F.col("angle") <= limit + F.col("slack") + MARGIN),
        "met",
    )
    single = F.col("slack") == 0
    whole = F.when(single, F.col("cos") >= threshold).otherwise(
        F.col("angle") + F.col("slack") <= limit - MARGIN
    )
    sure = met.where(whole)
    edge = met.where(~single & ~whole)
    # What lies on the edge: every vector of one unit against the other unit's leader, and
    # where that doesn't decide, against its vectors.
    ways = edge.select("a", "b", "b_weight", "b_radius").union(
        edge.select(F.col("b"), F.col("a"), "a_weight", "a_radius")
    ).toDF("mine", "other", "other_weight", "other_radius")
    faced = written(
        members.withColumnRenamed("unit", "mine")
        .drop("angle")
        .join(ways, "mine")
        .join(units.select(F.col("unit").alias("other"), F.col("v").alias("_leader")), "other")
        .withColumn("_angle", F.acos(cosine("v", "_leader")))
        .drop("_leader")
        .where(F.col("_angle") <= limit + F.col("other_radius") + MARGIN)
        .withColumn("_all", F.col("_angle") + F.col("other_radius") <= limit - MARGIN),
        "faced",
    )
    by_leader = faced.where("_all").select("vec_id", "mine", "other", F.col("other_weight").alias("n"))
    by_vector = (
        faced.where(~F.col("_all"))
        .join(members.select(F.col("unit").alias("other"), F.col("v").alias("_v")), "other")
        .where(cosine("v", "_v") >= threshold)
        .groupBy("vec_id", "mine", "other")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    loose = written(by_leader.union(by_vector), "loose")
    links = sure.select("a", "b").union(loose.select(F.col("mine").alias("a"), F.col("other").alias("b")))
    groups = components(links)
    of_unit = (
        sure.select(F.col("a").alias("unit"), F.col("b_weight").alias("n"))
        .union(sure.select(F.col("b"), F.col("a_weight")))
        .groupBy("unit")
        .agg(F.sum("n").alias("outside"))
    )
    of_vector = loose.groupBy("vec_id").agg(F.sum("n").alias("extra"))
    known = (
        units.select("unit", "weight")
        .join(of_unit, "unit", "left")
        .join(groups.withColumnRenamed("node", "unit"), "unit", "left")
        .select(
            "unit",
            (F.col("weight") - 1 + F.coalesce("outside", F.lit(0))).alias("shared"),
            F.coalesce("component", "unit").alias("component_id"),
        )
    )
    sound = (
        members.select("vec_id", "unit")
        .join(known, "unit")
        .join(of_vector, "vec_id", "left")
        .select("vec_id", (F.col("shared") + F.coalesce("extra", F.lit(0))).alias("n_links"), "component_id")
    )
    alone = rows.where(~F.col("sound")).select(
        "vec_id", F.lit(0).cast("long"), F.col("vec_id").alias("component_id")
    )
    return sound.union(alone).withColumn("kept", F.col("vec_id") == F.col("component_id"))


@query()
def op10_lattice(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "embeddings"))
