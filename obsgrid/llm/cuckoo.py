"""Exact duplicates through an index of cuckoo filters over live digests.

The index is cut into shards by digest. A shard holds the stored keys (the full SHA-256 of
every live text with the ids that carry it) and a cuckoo filter: four short fingerprints per
bucket, two candidate buckets per key. A filter miss proves a text new, so it is inserted
without a look at the stored keys; a hit is verified on the full digest in the key's bucket.
When an insertion finds no place after ``KICKS`` moves, the filter is doubled and rebuilt from
the stored keys. Deleting a digest takes one of its fingerprints out of the filter.

Rows are (digest, doc_id, copies) and never carry texts. Every task first folds its own rows
with a filter of its own, so of a text that makes up a third of all rows each task sends one
row; shards then meet few rows per text. A shard's memory grows with its distinct texts only,
and their number is set by ``shards``.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from obsgrid.llm.common import table, text_or_empty, written
from obsgrid.llm.registry import query

SLOTS = 4
KICKS = 200
FIRST_BUCKETS = 1 << 10
#: Distinct digests after which a task passes its folded rows on and starts afresh.
FLUSH = 200_000
#: Stands for a missing doc_id, below every other.
NO_ID = -(1 << 63)
#: Columns of the stored keys.
KEYS = "digest binary, keep_id long, copies long"


class CuckooFilter:
    """Approximate membership of 32-byte digests with insertion and deletion.

    ``contains`` is never wrong about a digest that is in; about others it errs in about
    8 / 65535 of the cases. A digest may be inserted once only; delete only what is in.
    """

    def __init__(self, buckets: int = FIRST_BUCKETS):
        self.mask = buckets - 1
        self.cells: list[list[int]] = [[] for _ in range(buckets)]
        self.turn = 0

    @staticmethod
    def _mark(digest: bytes) -> int:
        return int.from_bytes(digest[24:26], "little") or 1

    def _first(self, digest: bytes) -> int:
        return int.from_bytes(digest[16:24], "little") & self.mask

    def _other(self, bucket: int, mark: int) -> int:
        return (bucket ^ (mark * 0x9E3779B1)) & self.mask

    def contains(self, digest: bytes) -> bool:
        mark, first = self._mark(digest), self._first(digest)
        return mark in self.cells[first] or mark in self.cells[self._other(first, mark)]

    def insert(self, digest: bytes) -> bool:
        """False if no place was found; one mark is then homeless, so the filter must be rebuilt."""
        mark, bucket = self._mark(digest), self._first(digest)
        for at in (bucket, self._other(bucket, mark)):
            if len(self.cells[at]) < SLOTS:
                self.cells[at].append(mark)
                return True
        bucket = self._other(bucket, mark)
        for _ in range(KICKS):
            self.turn = (self.turn + 1) % SLOTS
            mark, self.cells[bucket][self.turn] = self.cells[bucket][self.turn], mark
            bucket = self._other(bucket, mark)
            if len(self.cells[bucket]) < SLOTS:
                self.cells[bucket].append(mark)
                return True
        return False

    def delete(self, digest: bytes) -> bool:
        mark, first = self._mark(digest), self._first(digest)
        for at in (first, self._other(first, mark)):
            if mark in self.cells[at]:
                self.cells[at].remove(mark)
                return True
        return False


class CuckooIndex:
    """One shard: the filter and the stored keys it answers for."""

    def __init__(self, keys: Iterable[tuple[bytes, int, int]] = ()):
        self.stored: dict[bytes, list[int]] = {}
        self.filter = CuckooFilter()
        self.resizes = 0
        for digest, doc_id, copies in keys:
            self.add(digest, doc_id, copies)

    def __len__(self) -> int:
        return len(self.stored)

    def _resize(self) -> None:
        buckets = len(self.filter.cells)
        while True:
            buckets *= 2
            self.resizes += 1
            self.filter = CuckooFilter(buckets)
            if all(self.filter.insert(digest) for digest in self.stored):
                return

    def add(self, digest: bytes, doc_id: int, copies: int = 1) -> bool:
        """Take in rows of one text; True if the text was not in the index."""
        if self.filter.contains(digest):
            known = self.stored.get(digest)
            if known is not None:
                known[0] = max(known[0], doc_id)
                known[1] += copies
                return False
        self.stored[digest] = [doc_id, copies]
        if not self.filter.insert(digest):
            self._resize()
        return True

    def remove(self, digest: bytes) -> bool:
        """Take a text out; False if it wasn't in."""
        if not self.filter.contains(digest) or digest not in self.stored:
            return False
        del self.stored[digest]
        return self.filter.delete(digest)

    def contains(self, digest: bytes) -> bool:
        return self.filter.contains(digest) and digest in self.stored

    def frame(self) -> pd.DataFrame:
        return pd.DataFrame(
            [(d, k, n) for d, (k, n) in self.stored.items()],
            columns=["digest", "keep_id", "copies"],
        )


def _fold(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    index = CuckooIndex()
    for rows in batches:
        for row in zip(rows["digest"], rows["keep_id"], rows["copies"]):
            index.add(*row)
            if len(index) >= FLUSH:
                yield index.frame()
                index = CuckooIndex()
    yield index.frame()


def digests(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, digest) of every row; a null doc_id becomes ``NO_ID``, a null text counts as empty."""
    return docs.select(
        F.coalesce(F.col(doc_id).cast("long"), F.lit(NO_ID)).alias("doc_id"),
        F.unhex(F.sha2(text_or_empty(text), 256)).alias("digest"),
    )


def _in_shards(rows: DataFrame, shards: int | None) -> DataFrame:
    return rows.repartition(shards, "digest") if shards else rows.repartition("digest")


def build(rows: DataFrame, shards: int | None = None) -> DataFrame:
    """The stored keys (digest, keep_id, copies) of rows (doc_id, digest)."""
    single = rows.select("digest", F.col("doc_id").alias("keep_id"), F.lit(1).cast("long").alias("copies"))
    folded = single.mapInPandas(_fold, KEYS)
    return _in_shards(folded, shards).mapInPandas(_merge, KEYS)


def _merge(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """A shard's rows, folded to one per digest; a filter in memory for the whole shard."""
    index = CuckooIndex()
    for rows in batches:
        for row in zip(rows["digest"], rows["keep_id"], rows["copies"]):
            index.add(*row)
    yield index.frame()


def insert(keys: DataFrame, rows: DataFrame, shards: int | None = None) -> DataFrame:
    """The keys of the index after the rows (doc_id, digest) came in."""
    fresh = build(rows, shards)
    return _in_shards(keys.union(fresh), shards).mapInPandas(_merge, KEYS)


def delete(keys: DataFrame, gone: DataFrame, shards: int | None = None) -> DataFrame:
    """The keys of the index without the given digests; unknown ones are ignored."""

    def take_out(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        index, out = CuckooIndex(), []
        for rows in batches:
            for digest, keep_id, copies in zip(rows["digest"], rows["keep_id"], rows["copies"]):
                if copies:
                    index.add(digest, keep_id, copies)
                else:
                    out.append(digest)
        for digest in out:
            index.remove(digest)
        yield index.frame()

    marks = gone.select("digest", F.lit(0).cast("long"), F.lit(0).cast("long")).distinct()
    return _in_shards(keys.union(marks), shards).mapInPandas(take_out, KEYS)


def exact_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, keep_id, group_size, kept, text_sha256) of every row.

    Of equal texts the largest doc_id stays. Null texts equal empty ones. Rows without a
    doc_id stand below all others; where no row of a text has one, keep_id is null and they are
    kept. A doc_id that occurs in several rows counts each of them in group_size and gives as many
    rows. An empty table gives no rows; other columns are not looked at.
    """
    rows = written(digests(docs, doc_id, text), "digests")
    keys = build(rows)
    named = lambda name: F.when(F.col(name) != NO_ID, F.col(name)).alias(name)
    return rows.join(keys, "digest").select(
        named("doc_id"),
        named("keep_id"),
        F.col("copies").alias("group_size"),
        (F.col("doc_id") == F.col("keep_id")).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"),
    )


@query(
    """
    WITH texts AS (SELECT doc_id, COALESCE(text, '') AS text FROM documents),
    groups AS (SELECT text, MAX(doc_id) AS keep_id, COUNT(*) AS group_size FROM texts GROUP BY text)
    SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(text) AS text_sha256
    FROM texts JOIN groups USING (text)
    """
)
def op7_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_duplicates(table(spark, sf_dir, "documents"))
