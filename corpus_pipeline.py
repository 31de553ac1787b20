"""From raw documents to token ids: filter, deduplicate, mix and encode.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame; ``run`` writes each one's rows to
the shared folder and hands them to the next. All stages but the last return the columns of
documents. Decisions go by id and text: rows that repeat an id with another text are documents of
their own, and so are those without an id; of rows that repeat both, dedup keeps one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from obsgrid.llm.bpe import encode
from obsgrid.llm.common import table, written
from obsgrid.llm.cuckoo import exact_duplicates
from obsgrid.llm.mixing import mix
from obsgrid.llm.near_texts import near_texts
from obsgrid.llm.toxicity import learn, toxicity


def without_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the learned lexicon scores below one half."""
    model = learn(docs, table(spark, sf_dir, "labels"))
    score = toxicity(model, F.col("text"))
    return docs.where(score < 0.5)


def _unused(docs: DataFrame, name: str) -> str:
    """A column name that the documents don't have."""
    while name.lower() in {c.lower() for c in docs.columns}:
        name += "_"
    return name


def _keyed(docs: DataFrame) -> tuple[DataFrame, list[str]]:
    """The rows with a key of id and text: an id that is never null, and the text's SHA-256."""
    names = [_unused(docs, name) for name in ("id_or_none", "digest")]
    digest = F.unhex(F.sha2(F.coalesce(F.col("text").cast("string"), F.lit("")), 256))
    return docs.withColumns(dict(zip(names, (_id_or_none(), digest)))), names


def _id_or_none():
    return F.coalesce(F.col("doc_id").cast("string"), F.lit("none"))


def _one_row_each(docs: DataFrame, kept: DataFrame) -> DataFrame:
    """The rows with the id and digest of a kept row, one for each; ``kept`` has both."""
    rows, key = _keyed(docs)
    count = _unused(rows, "rows")
    times = kept.groupBy(_id_or_none().alias(key[0]), F.col("digest").alias(key[1])).agg(
        F.count(F.lit(1)).alias(count)
    )
    found = rows.join(times, key)
    once = found.where(F.col(count) == 1)
    more = found.where(F.col(count) > 1).dropDuplicates(key)
    return once.union(more).select(docs.columns)


def without_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents with equal texts the one with the largest doc_id."""
    kept = exact_duplicates(docs).where("kept")
    return _one_row_each(docs, kept.select("doc_id", F.unhex("text_sha256").alias("digest")))


def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents linked by a similarity of 0.8 or more on five-word shingles the one with the
    smallest doc_id."""
    return _one_row_each(docs, near_texts(docs).where("kept").select("doc_id", "digest"))


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them."""
    times, turn = _unused(docs, "times"), _unused(docs, "turn")
    row = _unused(docs, "row")
    # The mix's ids are numbers of the rows, kept in a table, so ids that repeat or are null don't
    # multiply or vanish.
    numbered = written(docs.withColumn(row, F.monotonically_increasing_id()), "numbered")
    taken = mix(numbered, doc_id=row, seeded_by="doc_id").where(F.col("times") > 0)
    taken = taken.select(F.col("doc_id").alias(row), F.col("times").alias(times))
    repeats = F.explode(F.sequence(F.lit(1), F.col(times).cast("int"))).alias(turn)
    return numbered.join(taken, row).select(*docs.columns, repeats).drop(turn)


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document, with their digests."""
    return encode(docs)


STAGES = [
    ("toxicity", without_toxic),
    ("exact dedup", without_copies),
    ("simhash near-dedup", without_near_copies),
    ("mixing to target weights", mixed),
    ("byte-level bpe", encoded),
]

#: Learning, fingerprints and tokens are beyond SQL; the tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
