"""Exact quantiles in memory that does not grow with the data."""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SKETCH_ACCURACY = 10_000
#: Parts that a bracket is cut into in a pass over many values.
SLICES = 256
#: Values of a bracket that the last pass brings to the driver, for each wanted rank.
BUFFER = 4096


@dataclass
class _Wanted:
    """An order statistic: the value of ``rank`` (from 0) lies in [low, high]; ``below`` values are
    smaller than low, and ``held`` lie inside, as far as they have been counted."""

    column: str
    rank: int
    low: float
    high: float
    below: int | None = None
    held: int | None = None
    value: float | None = None

    def inside(self) -> Column:
        return F.col(self.column).between(self.low, self.high)


def _measure(df: DataFrame, columns: Sequence[str], chances: Sequence[float], accuracy: int) -> dict:
    """Extremes, count, mean and deviation per column, and for each chance the values between which
    a bounded sketch puts it: its ranks are off by 1 / accuracy of the rows at most. One row."""
    slack = 3.0 / accuracy
    edges = [e for p in chances for e in (max(p - slack, 0.0), min(p + slack, 1.0))]
    found = df.agg(
        *[
            F.struct(
                F.min(c).alias("least"),
                F.max(c).alias("most"),
                F.count(c).alias("n"),
                F.avg(c).alias("mean"),
                F.stddev_samp(c).alias("std"),
                F.percentile_approx(c, edges, accuracy).alias("edges"),
            ).alias(c)
            for c in columns
        ]
    ).first()
    return {c: found[c] for c in columns}


def _entries(wanted: list[_Wanted], part) -> Column:
    """For each bracket the number of its part that a row's value lies in; -1 is below it."""
    return F.array_compact(
        F.array(
            *[
                F.when(
                    F.col(w.column) <= w.high,
                    F.struct(
                        F.lit(i).alias("i"),
                        F.when(F.col(w.column) < w.low, F.lit(-1)).otherwise(part(w)).alias("s"),
                        F.col(w.column).alias("v"),
                    ),
                )
                for i, w in enumerate(wanted)
            ]
        )
    )


def _slice_of(w: _Wanted) -> Column:
    width = (w.high - w.low) / SLICES
    if not math.isfinite(width) or width == 0.0:
        # Too wide or too narrow to divide: cut at the middle.
        return (F.col(w.column) > w.low / 2 + w.high / 2).cast("int")
    return F.least(F.floor((F.col(w.column) - w.low) / width), F.lit(SLICES - 1)).cast("int")


def _narrow(df: DataFrame, wanted: list[_Wanted], extremes: Mapping[str, tuple]) -> None:
    """Cut every open bracket into slices, count them and what lies below, and keep the slice that
    holds the rank. A bracket that misses its rank becomes the whole column. A row per slice
    reaches the driver."""
    slices = (
        df.select(F.inline(_entries(wanted, _slice_of)))
        .groupBy("i", "s")
        .agg(F.count(F.lit(1)).alias("n"), F.min("v").alias("low"), F.max("v").alias("high"))
        .collect()
    )
    before = [0] * len(wanted)
    for w in wanted:
        w.held = None
    for r in sorted(slices, key=lambda r: (r["i"], r["s"])):
        w, below = wanted[r["i"]], before[r["i"]]
        if r["s"] >= 0 and below <= w.rank < below + r["n"]:
            w.low, w.high, w.below, w.held = r["low"], r["high"], below, r["n"]
        before[r["i"]] += r["n"]
    for w in wanted:
        if w.held is None:
            if (w.low, w.high) == extremes[w.column]:
                raise ValueError(f"{w.column} has values without an order")
            w.low, w.high = extremes[w.column]
        elif w.low == w.high:
            w.value = w.low


def _read(df: DataFrame, wanted: list[_Wanted]) -> None:
    """Bring the values of small brackets to the driver, equal ones as one row."""
    inside = F.array_compact(
        F.array(
            *[
                F.when(w.inside(), F.struct(F.lit(i).alias("i"), F.col(w.column).alias("v")))
                for i, w in enumerate(wanted)
            ]
        )
    )
    found = df.select(F.inline(inside)).groupBy("i", "v").agg(F.count(F.lit(1)).alias("n")).collect()
    for r in sorted(found, key=lambda r: (r["i"], r["v"])):
        w = wanted[r["i"]]
        if w.value is None and w.below <= w.rank < w.below + r["n"]:
            w.value = r["v"]
        w.below += r["n"]


def exact_quantiles(
    df: DataFrame,
    columns: Sequence[str],
    probabilities: Mapping[str, float],
    accuracy: int = SKETCH_ACCURACY,
) -> DataFrame:
    """Linear-interpolated quantiles of whole columns, with count, mean, sample deviation
    and extremes: one row per variable.

    ``percentile`` would keep every distinct value of a column in one task. Here one aggregate
    takes the moments and a bounded sketch, which brackets each wanted rank; a second counts what
    lies below each bracket and in each of its slices; a third brings the few values of the slice
    with the rank to the driver. Only a slice of more than ``BUFFER`` values that differ is cut
    again, and a bracket that misses its rank, which becomes the whole column. Every pass combines
    per task; the driver sees at most SLICES or BUFFER rows per wanted rank.

    The input is kept between the passes. Columns without values give NULLs.
    """
    spark = df.sparkSession
    chances = list(probabilities.values())
    values = df.select(*[F.col(c).cast("double").alias(c) for c in columns]).persist()
    try:
        moments = _measure(values, columns, chances, accuracy)
        extremes = {c: (m["least"], m["most"]) for c, m in moments.items()}
        positions = {
            (c, name): p * (moments[c]["n"] - 1)
            for c in columns
            for name, p in probabilities.items()
            if moments[c]["n"]
        }
        ranks: dict[tuple[str, int], _Wanted] = {}
        for (c, name), at in positions.items():
            turn = 2 * list(probabilities).index(name)
            # Of few rows the sketch's ranks say nothing, since a rank is more than its slack.
            few = moments[c]["n"] <= accuracy
            ends = extremes[c] if few else tuple(moments[c]["edges"][turn : turn + 2])
            for rank in (math.floor(at), math.ceil(at)):
                w = ranks.setdefault((c, rank), _Wanted(c, rank, *ends))
                if few and moments[c]["n"] <= BUFFER:
                    w.below, w.held = 0, moments[c]["n"]
        while open_ := [w for w in ranks.values() if w.value is None]:
            if small := [w for w in open_ if w.held is not None and w.held <= BUFFER]:
                _read(values, small)
                for w in small:
                    if w.value is None:
                        raise ValueError(f"{w.column} has values without an order")
            if large := [w for w in open_ if w not in small]:
                _narrow(values, large, extremes)
    finally:
        values.unpersist()

    def interpolated(c: str, name: str) -> float | None:
        if (c, name) not in positions:
            return None
        at = positions[c, name]
        a, b = (ranks[c, r].value for r in (math.floor(at), math.ceil(at)))
        return a + (b - a) * (at - math.floor(at))

    rows = [
        (
            c,
            *(moments[c][k] for k in ("n", "mean", "std", "least", "most")),
            *(interpolated(c, name) for name in probabilities),
        )
        for c in columns
    ]
    quantiles = ", ".join(f"{name} double" for name in probabilities)
    return spark.createDataFrame(
        rows,
        "variable string, count long, mean double, std double, minimum double, maximum double, "
        + quantiles,
    )
