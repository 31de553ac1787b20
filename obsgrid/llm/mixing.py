"""Mixing sources to target weights by fitting word budgets.

Every source gets a share of all words by its weight, up to ``REPEATS`` times its own size; what
is above is dealt to the others by weight. A source's budget is whole passes over its documents
plus a rest, and the rest is fitted to the word: documents are counted by exact length, most of
the rest is taken from all lengths in proportion, and bounded-knapsack dynamic programming over
the remaining counts fills what is then left. Where that misses the budget, the knapsack chooses
among all copies, up to ``REPEATS`` of each document, instead. The counts by length are turned into
documents by a seeded order.

Only counts reach a source's group: one row per distinct length. The documents of one source and
length are ranked in buckets, so a length that a third of all rows share is no single task.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from obsgrid.llm.common import WORD, table, text_or_empty, written
from obsgrid.llm.registry import query

#: Weights of the sources by code point, repeating; a null source comes last.
WEIGHTS = (5.0, 2.0, 1.0)
#: A source's target stops at so many times its size, and so does a document.
REPEATS = 3
SEED = 7
#: Words that dynamic programming fills at most; what is above is taken in proportion. Where a
#: length is above half of it, it fills ``WIDE`` of the longest, as far as ``WIDEST`` words go, and
#: two of the longest in any case.
RESIDUAL = 1 << 16
WIDE = 16
WIDEST = 1 << 21


def sizes(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    source: str = "source",
    seeded_by: str | None = None,
) -> DataFrame:
    """(doc_id, key, size, order): key is the source in code point order with null last, size in
    words, order a seeded hash of ``seeded_by`` (the id by default) and the text."""
    return docs.select(
        F.col(doc_id).cast("long").alias("doc_id"),
        F.coalesce(F.concat(F.lit("="), F.col(source).cast("string")), F.lit("~")).alias("key"),
        F.regexp_count(text_or_empty(text), F.lit(WORD)).cast("long").alias("size"),
        F.xxhash64(F.lit(SEED), F.col(seeded_by or doc_id), text_or_empty(text)).alias("order"),
    )


def targets(sized: DataFrame, weights: tuple = WEIGHTS) -> DataFrame:
    """(key, source_size, target), one row per source.

    Sources are sorted by the level of words per unit of weight at which each is full. The first
    that isn't full at the level that the ones before it leave to the rest sets the final level;
    those before it are capped. The windows see one row per source, whose number is that of the
    configured weights, not of the documents.
    """
    everything = Window.partitionBy()
    turn = (F.row_number().over(Window.orderBy("key")) - 1) % len(weights) + 1
    by_level = Window.orderBy("full_at", "key").rowsBetween(Window.unboundedPreceding, -1)
    rows = (
        sized.groupBy("key")
        .agg(F.sum("size").alias("source_size"))
        .withColumn("weight", F.element_at(F.array(*[F.lit(float(w)) for w in weights]), turn))
        .withColumn("cap", (F.col("source_size") * REPEATS).cast("double"))
        .withColumn("full_at", F.col("cap") / F.col("weight"))
    )
    words = F.sum("source_size").over(everything).cast("double")
    level = (words - F.coalesce(F.sum("cap").over(by_level), F.lit(0.0))) / (
        F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(by_level), F.lit(0.0))
    )
    # Later sources would see a lower level, since the ones before them don't reach their caps.
    rows = rows.withColumn("level", level).withColumn(
        "final", F.max(F.when(F.col("level") <= F.col("full_at"), F.col("level"))).over(everything)
    )
    return rows.select(
        "key",
        "source_size",
        F.least(F.col("cap"), F.coalesce(F.col("weight") * F.col("final"), F.col("cap"))).alias(
            "target"
        ),
    )


def _residual(longest: int) -> int:
    if longest <= RESIDUAL // 2:
        return RESIDUAL
    return longest * max(2, min(WIDE, WIDEST // longest))


def fill(lengths: np.ndarray, counts: np.ndarray, budget: int) -> np.ndarray:
    """How many copies of each length to take, up to ``REPEATS`` of each document, so that their
    words come as near to ``budget`` as the dynamic programming can bring them, on either side.
    Lengths are positive and ascending.

    Whole passes over all documents with some of them once more are tried first, since they spread
    the words over the most documents. Where they miss the budget, the copies are chosen freely.
    """
    size = int((lengths * counts).sum())
    if budget >= REPEATS * size:
        return REPEATS * counts
    passes, rest = divmod(max(0, budget), size)
    even = passes * counts + _fit(lengths, counts, rest)
    gap = abs(int((lengths * even).sum()) - budget)
    if not gap:
        return even
    free = _fit(lengths, REPEATS * counts, budget)
    return free if abs(int((lengths * free).sum()) - budget) < gap else even


def _fit(lengths: np.ndarray, counts: np.ndarray, budget: int) -> np.ndarray:
    """The same with ``counts`` copies of each length at hand."""
    take = np.zeros(len(lengths), np.int64)
    total = int((lengths * counts).sum())
    if budget >= total:
        return counts.copy()
    if budget <= 0:
        return take
    # In proportion, leaving about half a residual's worth of words to choose from. No length that
    # may be taken is above half a residual, so every one still can be.
    near = lengths[lengths <= 2 * budget]
    residual = _residual(int(near.max(initial=0)))
    share = max(0.0, (budget - residual / 2) / total)
    take = np.floor(counts * share).astype(np.int64)
    left = budget - int((lengths * take).sum())
    for i in np.argsort(-lengths, kind="stable"):
        if left <= residual:
            break
        more = min(int(counts[i] - take[i]), max(0, left - residual // 2) // int(lengths[i]))
        take[i] += more
        left -= more * int(lengths[i])
    return take + _knapsack(lengths, counts - take, min(left, residual))


def _knapsack(lengths: np.ndarray, counts: np.ndarray, budget: int) -> np.ndarray:
    """Bounded subset sum: for every reachable sum, the length that reached it first, so the
    choice is read back from the sum nearest to the budget. A sum of more than twice the budget is
    farther off than none at all."""
    took = np.zeros(len(lengths), np.int64)
    # Sums above the budget are of use only up to the first one by the longest length.
    longest = int(lengths[(counts > 0) & (lengths <= 2 * budget)].max(initial=0))
    top = budget + min(budget, longest)
    by = np.full(top + 1, -1, np.int32)
    reached = np.zeros(top + 1, bool)
    reached[0] = True
    for i in np.argsort(-lengths, kind="stable"):
        length, copies = int(lengths[i]), int(counts[i])
        if length > top or not copies or reached[budget]:
            continue
        # Sums in steps of the length as columns: how far above the last reached one each lies.
        steps = -(-(top + 1) // length)
        grid = np.zeros(steps * length, bool)
        grid[: top + 1] = reached
        rows = np.arange(steps, dtype=np.int32)[:, None]
        last = np.where(grid.reshape(steps, length), rows, np.int32(-1))
        np.maximum.accumulate(last, axis=0, out=last)
        fresh = ((last >= 0) & (rows - last <= copies)).reshape(-1)[: top + 1] & ~reached
        by[fresh] = i
        reached |= fresh
    sums = np.flatnonzero(reached)
    at = int(sums[np.argmin(np.abs(sums - budget))])
    while at:
        took[by[at]] += 1
        at -= int(lengths[by[at]])
    return took


def _plan(rows: pd.DataFrame) -> pd.DataFrame:
    """For one source: how often every document of a length is taken, and how many of them once
    more."""
    rows = rows[rows["size"] > 0].sort_values("size")
    out = rows[["key", "size", "n", "source_size", "target"]].assign(passes=0, extra=0)
    if len(rows):
        counts = rows["n"].to_numpy()
        copies = fill(rows["size"].to_numpy(), counts, int(round(float(rows["target"].iloc[0]))))
        out["passes"], out["extra"] = copies // counts, copies % counts
    return out


PLAN = "key string, size long, n long, source_size long, target double, passes long, extra long"


def mix(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    source: str = "source",
    weights: tuple = WEIGHTS,
    seeded_by: str | None = None,
) -> DataFrame:
    """(doc_id, size, source_size, target, taken, times) of every row.

    taken is size times the number of times that the mix takes the document; one without words
    costs nothing and is taken once. Null texts have size 0. Ids come as they are, null ones too;
    rows that repeat one are documents of their own. An empty table gives no rows; other columns
    are not looked at.
    """
    sized = written(sizes(docs, doc_id, text, source, seeded_by), "sizes")
    goals = written(targets(sized, weights), "targets")
    lengths = sized.groupBy("key", "size").agg(F.count(F.lit(1)).alias("n"))
    plan = written(
        lengths.join(goals, "key").groupBy("key").applyInPandas(_plan, PLAN), "mix-plan"
    )
    # Documents of one source and length are taken bucket by bucket along the seeded order. With
    # the square root of their number as buckets, no window sees more rows than that.
    choice = sized.join(plan, ["key", "size"]).withColumn(
        "bucket", F.pmod(F.col("order"), F.ceil(F.sqrt("n")))
    )
    group = ["key", "size", "bucket"]
    earlier = (
        Window.partitionBy("key", "size")
        .orderBy("bucket")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    starts = (
        choice.groupBy(*group)
        .agg(F.count(F.lit(1)).alias("held"))
        .select(*group, F.coalesce(F.sum("held").over(earlier), F.lit(0)).alias("before"))
    )
    rank = F.row_number().over(Window.partitionBy(*group).orderBy("order", "doc_id"))
    taken = (
        choice.withColumn("rank", rank)
        .join(starts, group)
        .withColumn(
            "times",
            F.col("passes") + (F.col("before") + F.col("rank") <= F.col("extra")).cast("long"),
        )
        .select("doc_id", "size", "source_size", "target", "times")
    )
    wordless = (
        sized.where(F.col("size") == 0)
        .join(goals, "key")
        .select("doc_id", "size", "source_size", "target", F.lit(1).cast("long").alias("times"))
    )
    return taken.union(wordless).select(
        "doc_id",
        "size",
        "source_size",
        "target",
        (F.col("size") * F.col("times")).alias("taken"),
        "times",
    )


@query()
def op1_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(table(spark, sf_dir, "documents"))
