"""Content-addressed WARC archive: payloads once, headers apart, records by join."""

from __future__ import annotations

import base64
import functools
import hashlib
import zlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rankframe.llm.common import stored

CRLF = "\r\n"
IDENTICAL = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


@dataclass(frozen=True)
class ArchiveConfig:
    """``min_bytes``: smaller payloads are never replaced by a revisit. ``date`` stands in
    every header, so that equal pages give equal archives."""

    min_bytes: int = 0
    date: str = "2000-01-01T00:00:00Z"
    level: int = 6
    broadcast_rows: int = 500_000


def base32(hexadecimal: F.Column, n_bytes: int = 20) -> F.Column:
    """Base32 of hexadecimal digits; every five of them are four base32 digits."""
    digits = [F.lpad(F.conv(F.substring(hexadecimal, k, 5), 16, 32), 4, "0") for k in range(1, 2 * n_bytes, 5)]
    return F.translate(F.concat(*digits), "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567")


def _pack(level: int, batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        payloads = [p.as_py().encode() for p in batch.column(1)]
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([zlib.compress(p, level) for p in payloads], pa.binary())], ["digest", "packed"])


def _record_id(page) -> F.Column:
    return F.concat(F.lit("<urn:page:"), F.coalesce(page.cast("string"), F.lit("none")), F.lit(">"))


def write_archive(pages: DataFrame, path: str, config: ArchiveConfig | None = None) -> None:
    """Archive ``pages(page_id, url, html)`` under ``path``: one WARC record per row.

    ``payloads`` holds the bytes of each different payload once, by SHA-256; rows that
    share a SHA-256 must also agree in SHA-1 and length, or the job fails. ``headers``
    holds the exact header bytes of every record and the digest of its payload.

    Of the records with equal payloads of ``min_bytes`` or more, the one with the smallest
    ``page_id`` (null last; among repeated rows, one of them) is the response and the
    others are revisits that refer to it; smaller payloads are all responses. A null html
    is an empty payload, a null url an empty one; line breaks in a url are escaped.

    Only keys and digests are grouped. Which pages hold no payload's first copy is
    broadcast up to ``broadcast_rows`` (40 bytes each), so payloads are written from where
    they are read; with more such pages they are joined by shuffle.
    """
    config = config or ArchiveConfig()
    html = F.coalesce(F.col("html").cast("string"), F.lit(""))
    source = pages.select(F.col("page_id").cast("long"), F.coalesce(F.col("url").cast("string"), F.lit("")).alias("url"), html.alias("html"))
    source = source.withColumn("digest", F.unhex(F.sha2("html", 256)))
    facts = source.select("page_id", "url", "digest", base32(F.sha1("html")).alias("sha1"), F.octet_length("html").cast("long").alias("n_bytes"))
    rows = stored(facts.withColumn("row", F.monotonically_increasing_id()), "warc-rows")
    order = F.struct(F.col("page_id").isNull().alias("last"), "page_id", "row")
    same = rows.groupBy("digest").agg(F.min(order).alias("first"), F.min("sha1").alias("least"), F.max("sha1").alias("most"), F.min("n_bytes").alias("short"), F.max("n_bytes").alias("long"))
    unverified = F.raise_error(F.lit("different payloads share a SHA-256 digest"))
    first = stored(
        same.select(
            "digest",
            F.when((F.col("least") == F.col("most")) & (F.col("short") == F.col("long")), F.col("first.row")).otherwise(unverified.cast("long")).alias("first_row"),
            F.col("first.page_id").alias("first_page"),
        ),
        "warc-firsts",
    )
    rows = stored(rows.join(first, "digest"), "warc-joined")

    key = F.coalesce("page_id", F.lit(-(1 << 63))).alias("page")
    holders = rows.select(key, "digest", (F.col("row") == F.col("first_row")).alias("first"))
    holders = holders.groupBy("page", "digest").agg(F.max("first").alias("first"), F.count(F.lit(1)).alias("times"))
    later = stored(holders.where("not first or times > 1"), "warc-later")
    held = source.select(key, "digest", "html")
    wanted = F.broadcast(later) if later.count() <= config.broadcast_rows else later
    held = held.join(wanted, ["page", "digest"], "left").where("first is null or first")
    once = held.where("times is null").select("digest", "html")
    if not later.where("first").isEmpty():  # one page id and payload in several rows
        once = once.unionByName(held.where("times is not null").dropDuplicates(["digest"]).select("digest", "html"))
    payloads = once.mapInArrow(functools.partial(_pack, config.level), "digest binary, packed binary")
    payloads.write.option("compression", "none").parquet(f"{path}/payloads")

    revisit = (F.col("row") != F.col("first_row")) & (F.col("n_bytes") >= config.min_bytes)
    url = F.regexp_replace(F.regexp_replace("url", "\r", "%0D"), "\n", "%0A")
    line = lambda name, value: F.concat(F.lit(f"{name}: "), value, F.lit(CRLF))
    header = F.concat(
        F.lit(f"WARC/1.1{CRLF}"),
        line("WARC-Type", F.when(revisit, "revisit").otherwise("response")),
        line("WARC-Record-ID", _record_id(F.col("page_id"))),
        line("WARC-Target-URI", url),
        line("WARC-Date", F.lit(config.date)),
        line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("sha1"))),
        F.when(revisit, F.concat(line("WARC-Profile", F.lit(IDENTICAL)), line("WARC-Refers-To", _record_id(F.col("first_page"))))).otherwise(""),
        line("Content-Type", F.lit("text/html")),
        line("Content-Length", F.when(revisit, F.lit("0")).otherwise(F.col("n_bytes").cast("string"))),
        F.lit(CRLF),
    )
    headers = rows.select("page_id", "digest", F.encode(header, "UTF-8").alias("header"))
    headers.write.option("compression", "zstd").parquet(f"{path}/headers")


def _unpack(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        payloads = [zlib.decompress(p.as_py()) for p in batch.column(3)]
        for payload, digest in zip(payloads, batch.column(1)):
            if hashlib.sha256(payload).digest() != digest.as_py():
                raise ValueError("a stored payload does not have its digest")
        sha1 = [base64.b32encode(hashlib.sha1(p).digest()).decode() for p in payloads]
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array(payloads, pa.binary()), pa.array(sha1, pa.string())], ["page_id", "header", "payload", "payload_sha1"])


def read_archive(spark: SparkSession, path: str) -> DataFrame:
    """The original records: ``page_id``, exact ``header`` bytes, full ``payload`` bytes
    (also of revisits) and the payload's base32 SHA-1. Every payload is verified against
    its digest."""
    headers = spark.read.parquet(f"{path}/headers")
    payloads = spark.read.parquet(f"{path}/payloads").select("digest", "packed")
    # neither side has a bound: never broadcast
    joined = headers.join(payloads.hint("merge"), "digest").select("page_id", "digest", "header", "packed")
    return joined.mapInArrow(_unpack, "page_id long, header binary, payload binary, payload_sha1 string")


def record_bytes(records: DataFrame) -> DataFrame:
    """``(page_id, record)``: what a WARC file holds; a revisit has no block."""
    revisit = F.decode("header", "UTF-8").contains(f"{CRLF}WARC-Type: revisit{CRLF}")
    end = F.encode(F.lit(CRLF * 2), "UTF-8")
    return records.select("page_id", F.when(revisit, F.concat("header", end)).otherwise(F.concat("header", "payload", end)).alias("record"))


def describe_records(records: DataFrame) -> DataFrame:
    """What headers and payloads of read records say."""
    header = F.decode("header", "UTF-8")
    field = lambda name, value: F.regexp_extract(header, rf"\r\n{name}: {value}\r\n", 1)
    stated = field("WARC-Payload-Digest", "sha1:([A-Z2-7]*)")
    digest = F.when(stated == F.col("payload_sha1"), stated).otherwise(F.raise_error(F.lit("a header states another digest")).cast("string"))
    refers = field("WARC-Refers-To", "<urn:page:(-?[0-9]+)>")
    return records.select(
        "page_id",
        F.octet_length("payload").cast("long").alias("payload_bytes"),
        digest.alias("payload_digest"),
        field("WARC-Type", "([a-z]+)").alias("record_type"),
        F.when(refers != "", refers.cast("long")).alias("refers_to"),
    )


#: The described archive in DuckDB, for all payload sizes; base32 is put together from the digest's bits.
WARC_SQL = r"""
WITH p AS (
  SELECT page_id, coalesce(html, '') AS payload, sha1(coalesce(html, '')) AS hex FROM pages
), bits AS (
  SELECT page_id, string_agg(substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + ((five >> (5 * (3 - j))) & 31)::INT, 1), '' ORDER BY k, j) AS b32
  FROM (SELECT page_id, k, j, ('0x' || substr(hex, 1 + 5 * k, 5))::BIGINT AS five
        FROM p, (SELECT unnest(range(0, 8))::INT AS k) ks, (SELECT unnest(range(0, 4))::INT AS j) js)
  GROUP BY page_id
), firsts AS (
  SELECT page_id, payload, min(page_id) OVER (PARTITION BY hex) AS first FROM p
)
SELECT f.page_id, octet_length(encode(f.payload))::BIGINT AS payload_bytes, b.b32 AS payload_digest,
       CASE WHEN f.page_id = f.first THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN f.page_id <> f.first THEN f.first END AS refers_to
FROM firsts f JOIN bits b USING (page_id)
"""
