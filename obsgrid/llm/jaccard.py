"""Near duplicates by shingle sets: all pairs at a Jaccard similarity of 0.8 or more, exactly.

A text is the set of its runs of five words, each hashed to 64 bits. Two sets at 0.8 or more share
one of their first ``_prefix`` shingles in any order that is the same for all sets, so documents
meet only under those. The order puts shingles that are frequent in a sample last; it decides how
many pairs meet, never which ones link. Pairs that meet are dropped only by bounds that hold for
certain (sizes, and parities of 2048 bits, which differ no more often than the sets do), and all
others are counted on the whole sets.

Equal sets are folded to one row first. Below a shingle everybody is first compared with one leader;
after that only documents of different components are compared with each other, so a large group of
near copies costs no pairs, and the components are those of all links.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from obsgrid.llm.common import dropped, written
from obsgrid.llm.components import components
from obsgrid.llm.simhash import SEED

SHINGLE = 5
#: One in so many documents is looked at for frequent shingles.
SAMPLE = 8
#: Sampled documents from which a shingle is frequent, and how many frequent ones are kept.
FREQUENT = 4
FREQUENT_KEPT = 100_000
#: Longs that hold a set's parities.
PARITY = 32
#: Passes over leaders at most; what they leave is compared in full.
LEADERS = 3

_WORDS = re.compile(rb"[^\x20\x09-\x0D]+")


def shingle_set(text: str | None) -> np.ndarray:
    """The distinct shingles' hashes, ascending. Fewer than five words are one shingle."""
    words = _WORDS.findall((text or "").encode("utf-8", "replace").lower())
    if not words:
        return np.empty(0, np.int64)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    line = b" ".join(words)
    stops = ends[min(SHINGLE, len(words)) - 1 :].tolist()
    starts = np.concatenate([[0], ends[:-1] + 1])[: len(stops)].tolist()
    digest = xxhash.xxh64_intdigest
    hashes = (digest(line[i:j], SEED) for i, j in zip(starts, stops))
    return np.unique(np.fromiter(hashes, np.uint64, len(stops)).view(np.int64))


def _node(hashes: np.ndarray) -> int:
    node = xxhash.xxh64_intdigest(hashes.tobytes(), SEED)
    return node - ((node >> 63) << 64)


def _prefix(size: int) -> int:
    return size - (4 * size + 4) // 5 + 1 if size else 0


def _parities(hashes: np.ndarray) -> np.ndarray:
    places = np.bincount(hashes.view(np.uint64) % np.uint64(64 * PARITY), minlength=64 * PARITY)
    return np.packbits((places & 1).astype(np.uint8)).view(np.int64)


def _frequent(docs: DataFrame, doc_id: str, text: str) -> tuple[np.ndarray, np.ndarray]:
    """Shingles that are frequent in the sample, ascending, and their numbers of documents."""

    @F.pandas_udf("array<long>")
    def shingles(texts: pd.Series) -> pd.Series:
        return pd.Series([shingle_set(t) for t in texts], dtype=object)

    sample = docs.where(F.pmod(F.xxhash64(F.lit(SEED), doc_id), F.lit(SAMPLE)) == 0)
    counts = written(
        sample.select(F.explode(shingles(F.col(text).cast("string"))).alias("key"))
        .groupBy("key")
        .agg(F.count(F.lit(1)).alias("n"))
        .where(F.col("n") >= FREQUENT),
        "frequent",
    )
    levels = counts.groupBy(F.floor(F.log2("n")).alias("level")).agg(F.count(F.lit(1)).alias("n"))
    least, held = None, 0
    for row in sorted(levels.collect(), reverse=True):
        held += row["n"]
        if held > FREQUENT_KEPT:
            break
        least = row["level"]
    kept = [] if least is None else counts.where(F.col("n") >= 2 ** int(least)).collect()
    dropped(counts)
    kept.sort()
    return np.array([r["key"] for r in kept], np.int64), np.array([r["n"] for r in kept], np.int64)


def _marked(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """(doc_id, node, size, parities, keys): node is a hash of the set, keys its first shingles."""
    spark = docs.sparkSession
    common = spark.sparkContext.broadcast(_frequent(docs, doc_id, text))

    def mark(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        frequent, numbers = common.value
        for rows in batches:
            out = []
            for i, t in zip(rows["doc_id"], rows["text"]):
                hashes = shingle_set(t)
                rank = np.zeros(len(hashes), np.int64)
                if len(frequent):
                    at = np.minimum(np.searchsorted(frequent, hashes), len(frequent) - 1)
                    rank = np.where(frequent[at] == hashes, numbers[at], 0)
                first = hashes[np.lexsort((hashes, rank))[: _prefix(len(hashes))]]
                out.append((i, _node(hashes), len(hashes), _parities(hashes), first))
            yield pd.DataFrame(out, columns=["doc_id", "node", "size", "parities", "keys"])

    rows = docs.where(F.col(doc_id).isNotNull()).select(
        F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text")
    )
    return rows.mapInPandas(
        mark, "doc_id long, node long, size long, parities array<long>, keys array<long>"
    )


def _linked(pairs: DataFrame, nodes: DataFrame, docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """Those of the pairs (a, b) whose sets are at 0.8 or more."""
    ends = nodes.select("node", "size", "parities")
    both = pairs.join(ends.toDF("a", "a_size", "a_par"), "a").join(ends.toDF("b", "b_size", "b_par"), "b")
    apart = sum(F.bit_count(F.col("a_par")[i].bitwiseXOR(F.col("b_par")[i])) for i in range(PARITY))
    sizes = F.col("a_size") + F.col("b_size")
    close = written(
        both.where(F.least("a_size", "b_size") * 5 >= F.greatest("a_size", "b_size") * 4)
        .where(apart * 9 <= sizes)
        .select("a", "b", sizes.alias("sizes")),
        "close-pairs",
    )

    def sets_of(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in batches:
            sets = [shingle_set(t) for t in rows["text"]]
            yield pd.DataFrame({"node": rows["node"], "own": [_node(x) for x in sets], "set": sets})

    # Texts come by the doc_id of the folded row; one that repeats with another text gives another
    # node and is left out.
    wanted = close.select(F.explode(F.array("a", "b")).alias("node")).distinct()
    ids = nodes.join(wanted, "node").select("node", "doc_id")
    texts = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    sets = written(
        texts.join(ids, "doc_id")
        .select("node", "text")
        .mapInPandas(sets_of, "node long, own long, set array<long>")
        .where("own = node")
        .select("node", "set")
        .dropDuplicates(["node"]),
        "shingle-sets",
    )
    found = (
        close.join(sets.toDF("b", "b_set"), "b")
        .join(sets.toDF("a", "a_set"), "a")
        .where(F.size(F.array_intersect("a_set", "b_set")) * 9 >= F.col("sizes") * 4)
        .select("a", "b")
    )
    out = written(found, "jaccard-links")
    dropped(close)
    dropped(sets)
    return out


def similar_documents(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, component_id) of every row that has a doc_id.

    Null texts and texts without words are equal to each other and to nothing else. The component
    is named by its smallest doc_id. Repeated ids give as many rows; an empty table gives none.
    """
    marked = written(_marked(docs, doc_id, text), "shingle-marks")
    nodes = written(
        marked.groupBy("node").agg(
            F.min("doc_id").alias("doc_id"),
            *[F.first(c).alias(c) for c in ("size", "parities", "keys")],
        ),
        "shingle-nodes",
    )
    keys = nodes.select("node", F.explode("keys").alias("key"))
    shared = keys.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("key")
    meets = written(keys.join(shared, "key"), "shared-shingles")

    links = None
    groups = nodes.select("node", F.col("node").alias("component")).where("false")
    for turn in range(LEADERS):
        of = meets.join(groups, "node", "left").select(
            "key", "node", F.coalesce("component", "node").alias("component")
        )
        order = F.struct(F.xxhash64(F.lit(turn), "node"), "node", "component")
        lead = of.groupBy("key").agg(F.min(order).alias("lead"))
        pairs = (
            of.join(lead, "key")
            .where("component != lead.component")
            .select(F.least("node", "lead.node").alias("a"), F.greatest("node", "lead.node").alias("b"))
            .distinct()
        )
        found = _linked(pairs, nodes, docs, doc_id, text)
        if found.isEmpty():
            break
        links = found if links is None else links.union(found)
        groups = written(components(links), "groups")
    of = meets.join(groups, "node", "left").select(
        "key", "node", F.coalesce("component", "node").alias("component")
    )
    of = of.join(nodes.select("node", "size"), "node")
    other = of.withColumnsRenamed({"node": "b", "component": "_c", "size": "_s"})
    pairs = (
        of.withColumnRenamed("node", "a")
        .join(other, "key")
        .where("a < b and component != _c")
        .where("least(size, _s) * 5 >= greatest(size, _s) * 4")
        .select("a", "b")
        .distinct()
    )
    found = _linked(pairs, nodes, docs, doc_id, text)
    links = found if links is None else links.union(found)
    groups = written(components(links), "groups")
    of_node = nodes.select("node", "doc_id").join(groups, "node", "left").select(
        "node", "doc_id", F.coalesce("component", "node").alias("component")
    )
    least = of_node.groupBy("component").agg(F.min("doc_id").alias("component_id"))
    named = of_node.drop("doc_id").join(least, "component").select("node", "component_id")
    return marked.select("doc_id", "node").join(named, "node").select("doc_id", "component_id")
