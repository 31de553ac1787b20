"""Near duplicates by SimHash and multi-index hashing.

A fingerprint is 64 bits: each is the majority of that bit among the XXH64 of all shingles.
Fingerprints within ``DISTANCE`` bits link. They are cut into two segments, so linked ones
differ in at most one bit in one of them: every distinct fingerprint looks up the Hamming
ball of radius one around each segment in the table of segments, and candidates are verified
on all 64 bits. Only the flips from 0 to 1 are looked up, because of two segments that differ
in one bit just one has a 0 there.

Spark sizes an unfolded table by the rows before, so joins of balls ask for a merge: none is broadcast.

Documents of equal fingerprint are folded to one row first, so copies cost no pairs. A segment
value that many distinct fingerprints share is not joined with itself: inside such a bucket
the rest of the fingerprint is indexed once more by Hamming balls, and whoever meets in a ball
is tied to the ball's smallest member (``_crowded``), which gives the same components.
"""

from __future__ import annotations

import re

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from obsgrid.llm.common import WORD, dropped, table, text_or_empty, written
from obsgrid.llm.components import components
from obsgrid.llm.registry import query

SEED = 42
SHINGLE = 3
#: Largest number of differing bits of a link.
DISTANCE = 3
#: Distinct fingerprints from which a bucket is indexed once more instead of compared.
CROWD = 256
#: Shingles hashed at a time; bounds a task's memory however long a text is.
CHUNK = 1 << 17

_UPPER = {i: i + 32 for i in range(65, 91)}


def _bit_counts(words: list[bytes], shingle: int) -> tuple[np.ndarray, int]:
    """How many shingles have each bit (most significant first), and the number of shingles."""
    if not words:
        return np.zeros(64, np.int64), 0
    total = max(1, len(words) - shingle + 1)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    line = b" ".join(words)
    starts = np.concatenate([[0], ends[:-1] + 1])[:total].tolist()
    stops = ends[min(shingle, len(words)) - 1 :].tolist()
    counts = np.zeros(64, np.int64)
    digest = xxhash.xxh64_intdigest
    for at in range(0, total, CHUNK):
        spans = zip(starts[at : at + CHUNK], stops[at : at + CHUNK])
        hashes = np.array([digest(line[i:j], SEED) for i, j in spans], dtype=">u8")
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1)
        counts += bits.sum(axis=0, dtype=np.int64)
    return counts, total


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """The fingerprint as a signed 64-bit integer; of a text without words it is zero."""
    words = re.findall(rb"[^\x20\x09-\x0D]+", (text or "").encode("utf-8", "replace").lower())
    counts, total = _bit_counts(words, shingle)
    bits = (2 * counts > total).astype(np.uint8)
    return int(np.packbits(bits).view(">i8")[0])


def fingerprints(docs: DataFrame, text: str = "text", shingle: int = SHINGLE) -> Column:
    @F.pandas_udf("long")
    def mark(texts: pd.Series) -> pd.Series:
        return pd.Series([fingerprint(t, shingle) for t in texts], dtype="int64")

    return mark(docs[text])


def _segments(rows: DataFrame) -> DataFrame:
    """Two rows per fingerprint: the segment's number and value as the key."""
    high = F.shiftrightunsigned("fp", 32)
    low = F.col("fp").bitwiseAND(0xFFFFFFFF)
    return rows.select(
        "node",
        "fp",
        F.explode(F.array(high, low.bitwiseOR(F.lit(1 << 32)))).alias("key"),
    )


def _probes(segments: DataFrame) -> DataFrame:
    """Each segment's own key, and the keys with one more bit set."""
    flips = [
        F.when(F.col("key").bitwiseAND(F.lit(1 << i)) == 0, F.col("key").bitwiseOR(F.lit(1 << i)))
        for i in range(32)
    ]
    keys = F.array_compact(F.array(F.col("key"), *flips))
    return segments.select("node", "fp", F.col("key").alias("own"), F.explode(keys).alias("key"))


def _rest(fp: str, key: str) -> Column:
    """The half of a fingerprint that the key doesn't hold."""
    second = F.shiftrightunsigned(key, 32) == 1
    return F.when(second, F.shiftrightunsigned(fp, 32)).otherwise(
        F.col(fp).bitwiseAND(0xFFFFFFFF)
    )


def _crowded(members: DataFrame, lookups: DataFrame) -> DataFrame:
    """Links that give a crowded bucket's components without its pairs.

    With d bits already different in the segment, the rests may differ in 3 - d: two values
    differ in at most 3 bits just if a ball of radius 1 around one and of radius 2 around the
    other share a value, and in at most 2 bits if balls of radius 1 do. All lookups that put a
    value into their small ball link to all members that have it in theirs, so each is tied to
    the smallest of the other side.
    """
    one = [1 << i for i in range(32)]
    two = [a | b for i, a in enumerate(one) for b in one[i + 1 :]]
    near = F.array(*[F.lit(m).cast("long") for m in [0, *one]])
    far = F.array(*[F.lit(m).cast("long") for m in two])
    small = lookups.select(
        "node",
        "key",
        (F.col("own") != F.col("key")).alias("moved"),
        F.explode(near).alias("_m"),
        _rest("fp", "key").alias("rest"),
    ).withColumn("value", F.col("rest").bitwiseXOR(F.col("_m")))
    large = members.select(
        "node",
        "key",
        _rest("fp", "key").alias("rest"),
        F.explode(F.concat(near, far)).alias("_m"),
    ).select(
        "node",
        "key",
        F.col("rest").bitwiseXOR(F.col("_m")).alias("value"),
        (F.bit_count("_m") < 2).alias("close"),
    )
    at = ["key", "value"]
    balls = (
        small.groupBy(*at)
        .agg(
            F.min(F.when(~F.col("moved"), F.col("node"))).alias("own_min"),
            F.min(F.when(F.col("moved"), F.col("node"))).alias("moved_min"),
        )
        .hint("merge")
        .join(
            large.groupBy(*at).agg(
                F.min("node").alias("any_min"),
                F.min(F.when(F.col("close"), F.col("node"))).alias("close_min"),
            ),
            at,
        )
    )
    lookups_tied = small.hint("merge").join(balls, at).select(
        F.col("node").alias("a"),
        F.when(F.col("moved"), F.col("close_min")).otherwise(F.col("any_min")).alias("b"),
    )
    members_tied = large.hint("merge").join(balls, at).select(
        F.col("node").alias("a"),
        F.explode(
            F.array(F.col("own_min"), F.when(F.col("close"), F.col("moved_min")))
        ).alias("b"),
    )
    return lookups_tied.union(members_tied).where("b is not null and a != b").distinct()


def links(distinct_prints: DataFrame, crowd: int = CROWD) -> DataFrame:
    """Links (a, b) between rows (node, fp) of distinct fingerprints within three bits.

    Outside crowded buckets these are all pairs; inside them they are enough of the links for
    the same components.
    """
    segments = _segments(distinct_prints)
    sizes = segments.groupBy("key").agg(F.count(F.lit(1)).alias("n"))
    crowds = written(sizes.where(F.col("n") > crowd).select("key"), "crowds")
    probes = _probes(segments)
    found = (
        segments.join(crowds, "key", "left_anti")
        .withColumnsRenamed({"node": "b", "fp": "_fp"})
        .join(probes.withColumnRenamed("node", "a").hint("merge"), "key")
        .where("a != b")
        .where(F.bit_count(F.col("fp").bitwiseXOR(F.col("_fp"))) <= DISTANCE)
        .select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
        .distinct()
    )
    if crowds.isEmpty():
        return found
    return found.union(
        _crowded(
            segments.join(crowds, "key", "left_semi"), probes.join(crowds, "key", "left_semi")
        )
    )


def near_duplicates(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", shingle: int = SHINGLE
) -> DataFrame:
    """(doc_id, fingerprint, component_id) of every row.

    Null and empty texts have fingerprint zero and link like any other; rows without a doc_id
    are left out, since they name no document; a doc_id that occurs twice gives two rows. An
    empty table gives no rows. Other columns are not looked at.
    """
    marked = written(
        docs.where(F.col(doc_id).isNotNull()).select(
            F.col(doc_id).cast("long").alias("doc_id"), fingerprints(docs, text, shingle).alias("fp")
        ),
        "fingerprints",
    )
    prints = written(marked.groupBy("fp").agg(F.min("doc_id").alias("node")), "prints")
    groups = components(links(prints))
    of_print = prints.join(groups, "node", "left").select(
        "fp", F.coalesce("component", "node").alias("component_id")
    )
    return marked.join(of_print, "fp").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )


@query()
def op5_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))
