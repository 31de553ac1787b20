"""Connected components of a link table, by alternating large and small stars.

Every round links each node's neighbours to the smallest node seen so far, first from above
and then from below, until every component is one star around its smallest member. A round
is two joins and aggregates by node; per-task minima come before each shuffle and a hub's
links are split by the skew-join rule. Links never reach the driver, only their count and a
checksum do.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from obsgrid.llm.common import dropped, written


def _large_star(links: DataFrame) -> DataFrame:
    both = links.union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("_m"))
    return (
        both.join(least, "a")
        .where(F.col("b") > F.col("a"))
        .select(F.col("b").alias("a"), F.least("a", "_m").alias("b"))
        .distinct()
    )


def _small_star(links: DataFrame) -> DataFrame:
    least = links.groupBy("a").agg(F.min("b").alias("_m"))
    to_least = links.join(least, "a").select(F.col("b").alias("a"), F.col("_m").alias("b"))
    return to_least.where(F.col("a") != F.col("b")).union(least).distinct()


def _state(links: DataFrame) -> tuple:
    sums = links.agg(
        F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))
    ).first()
    return tuple(sums)


def components(links: DataFrame) -> DataFrame:
    """(node, component) of every node that has a link; component is the smallest node reached.

    ``links`` has two long columns named a and b; order, repeats and self-links don't matter,
    rows with a null are no links. No links give no rows.
    """
    stars = written(
        links.where(F.col("a") != F.col("b"))
        .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        .distinct(),
        "links",
    )
    before = _state(stars)
    while before[0]:
        nearer = written(_small_star(_large_star(stars)), "links")
        dropped(stars)
        stars, now = nearer, _state(nearer)
        if now == before:
            break
        before = now
    nodes = stars.select(F.col("a").alias("node"), F.col("b").alias("component"))
    roots = stars.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return nodes.union(roots)
