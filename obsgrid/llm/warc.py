"""A content-addressed WARC archive.

Payload bytes are stored once under their SHA-256; the exact header of every record, from the
version line to the end of the HTTP header, is kept apart. A record is its header joined with
the payload of its digest, which is verified against the bytes on reading.

Only ids, addresses and digests are shuffled to find the first record of a payload. Payloads are
then picked by the id of that record, so a payload that a third of all pages share is moved once.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from obsgrid.llm.common import table, text_or_empty
from obsgrid.llm.registry import query
from obsgrid.session import scratch_path

#: Records of smaller payloads are written as responses even if they repeat.
REVISIT_BYTES = 100
DATE = "2024-01-01T00:00:00Z"
END = "\r\n"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


@dataclass(frozen=True)
class Archive:
    """Where the two tables of an archive are."""

    headers: str
    payloads: str


def _address(page_id: Column) -> Column:
    return F.concat(F.lit("<urn:x-page:"), page_id.cast("string"), F.lit(">"))


def _line(name: str, value: Column) -> Column:
    """A header line; none if the value is null."""
    return F.coalesce(F.concat(F.lit(f"{name}: "), value, F.lit(END)), F.lit(""))


def _header() -> Column:
    response = F.col("refers_to").isNull()
    http = F.concat(
        F.lit(f"HTTP/1.1 200 OK{END}Content-Type: text/html; charset=utf-8{END}"),
        _line("Content-Length", F.col("payload_bytes").cast("string")),
        F.lit(END),
    )
    size = F.length(http) + F.when(response, F.col("payload_bytes")).otherwise(0)
    # A line break in an address would end its header line.
    address = F.replace(F.replace("url", F.lit("\r"), F.lit("%0D")), F.lit("\n"), F.lit("%0A"))
    return F.concat(
        F.lit(f"WARC/1.1{END}"),
        _line("WARC-Type", F.when(response, "response").otherwise("revisit")),
        _line("WARC-Record-ID", _address(F.col("page_id"))),
        F.lit(f"WARC-Date: {DATE}{END}"),
        _line("WARC-Target-URI", address),
        _line("WARC-Payload-Digest", F.concat(F.lit("sha256:"), F.col("digest"))),
        _line("WARC-Profile", F.when(~response, F.lit(PROFILE))),
        _line("WARC-Refers-To", _address(F.col("refers_to"))),
        F.lit(f"Content-Type: application/http; msgtype=response{END}"),
        _line("Content-Length", size.cast("string")),
        F.lit(END),
        http,
    )


def write_archive(pages: DataFrame, page_id: str = "page_id", url: str = "url", html: str = "html") -> Archive:
    """Write one record per row.

    Of records with equal payloads of at least REVISIT_BYTES bytes the one with the smallest
    page_id is the response, the others revisit it. A null html is an empty payload, a null url
    leaves its line out. Rows without a page_id are left out; a page_id that repeats gives a
    record per row, all of them responses if they hold the smallest id. An empty table gives an
    empty archive; other columns are not looked at.
    """
    spark = pages.sparkSession
    payload = F.encode(text_or_empty(html), "utf-8")
    rows = pages.where(F.col(page_id).isNotNull()).select(
        F.col(page_id).cast("long").alias("page_id"),
        F.col(url).cast("string").alias("url"),
        F.sha2(payload, 256).alias("digest"),
        payload.alias("payload"),
    )
    marks = rows.select(
        "page_id", "url", "digest", F.octet_length("payload").cast("long").alias("payload_bytes")
    )
    firsts = marks.groupBy("digest").agg(F.min("page_id").alias("first_id"))
    repeats = (F.col("payload_bytes") >= REVISIT_BYTES) & (F.col("page_id") != F.col("first_id"))
    archive = Archive(scratch_path(spark, "warc-headers"), scratch_path(spark, "warc-payloads"))
    (
        marks.join(firsts, "digest")
        .withColumn("refers_to", F.when(repeats, F.col("first_id")))
        .select(F.encode(_header(), "utf-8").alias("header"))
        .write.parquet(archive.headers)
    )
    chosen = firsts.withColumnsRenamed({"first_id": "page_id", "digest": "_digest"})
    (
        rows.join(chosen, "page_id")
        .where(F.col("digest") == F.col("_digest"))
        .dropDuplicates(["page_id", "digest"])
        .select("digest", "payload")
        .write.parquet(archive.payloads)
    )
    return archive


def _field(name: str, value: str) -> Column:
    """A value from the header; null if the line is missing."""
    found = F.regexp_extract("text", rf"(?:^|\r\n){name}: {value}\r\n", 1)
    return F.when(found != "", found)


def read_archive(spark: SparkSession, archive: Archive) -> DataFrame:
    """(page_id, url, record_type, refers_to, payload_digest, payload_bytes, payload, record).

    record holds the bytes of the whole record, up to the blank lines that end it. A payload that
    is missing, or that isn't the one its digest names, fails.
    """
    headers = spark.read.schema("header binary").parquet(archive.headers)
    stored = spark.read.schema("digest string, payload binary").parquet(archive.payloads)
    verified = stored.select(
        F.col("digest").alias("_digest"),
        F.col("payload").alias("_payload"),
        F.sha2("payload", 256).alias("_found"),
        F.octet_length("payload").cast("long").alias("_bytes"),
    )
    fields = headers.withColumn("text", F.decode("header", "utf-8")).select(
        "header",
        _field("WARC-Record-ID", r"<urn:x-page:(-?\d+)>").cast("long").alias("page_id"),
        _field("WARC-Target-URI", r"([^\r]*)").alias("url"),
        _field("WARC-Type", r"(\w+)").alias("record_type"),
        _field("WARC-Refers-To", r"<urn:x-page:(-?\d+)>").cast("long").alias("refers_to"),
        _field("WARC-Payload-Digest", r"sha256:(\w+)").alias("digest"),
        F.regexp_extract("text", r"\r\n\r\n(?s).*\r\nContent-Length: (\d+)\r\n", 1)
        .cast("long")
        .alias("length"),
    )
    whole = (F.col("_found") == F.col("digest")) & (F.col("_bytes") == F.col("length"))
    body = F.when(F.col("record_type") == "response", F.col("_payload")).otherwise(F.lit(b""))
    return fields.join(verified, F.col("digest") == F.col("_digest"), "left").select(
        "page_id",
        "url",
        "record_type",
        "refers_to",
        F.when(whole, F.col("_found"))
        .otherwise(F.raise_error(F.concat(F.lit("payload missing or changed: "), F.col("digest"))))
        .alias("payload_digest"),
        F.when(whole, F.col("_bytes")).alias("payload_bytes"),
        F.when(whole, F.col("_payload")).alias("payload"),
        F.concat("header", body, F.lit(b"\r\n\r\n")).alias("record"),
    )


def export_warc(spark: SparkSession, archive: Archive, path: str) -> None:
    """The records as gzipped WARC files, one per task. Their end is the line separator."""
    text = F.decode("record", "utf-8")
    whole = F.when(F.col("payload_digest").isNotNull(), text)
    read_archive(spark, archive).select(
        F.substring(whole, F.lit(1), F.length(whole) - 4).alias("value")
    ).write.text(path, compression="gzip", lineSep="\r\n\r\n")


@query(
    f"""
    WITH payloads AS (
      SELECT page_id, COALESCE(html, '') AS html, sha256(COALESCE(html, '')) AS payload_digest,
        CAST(strlen(COALESCE(html, '')) AS BIGINT) AS payload_bytes FROM pages),
    firsts AS (SELECT payload_digest, MIN(page_id) AS first_id FROM payloads GROUP BY payload_digest)
    SELECT page_id, payload_bytes, payload_digest,
      CASE WHEN payload_bytes >= {REVISIT_BYTES} AND page_id <> first_id
        THEN 'revisit' ELSE 'response' END AS record_type,
      CASE WHEN payload_bytes >= {REVISIT_BYTES} AND page_id <> first_id
        THEN first_id END AS refers_to
    FROM payloads JOIN firsts USING (payload_digest)
    """
)
def op6_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    archive = write_archive(table(spark, sf_dir, "pages"))
    return read_archive(spark, archive).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"
    )
