"""WARC archives with revisit records.

Headers are shuffled by payload digest; of equal payloads of at least 100 bytes the record with the smallest
page_id stays a response and the others become revisit records that refer to it. Archives (WARC 1.1) are written
by Spark's text sink in gzip parts, with the record end CRLF CRLF as its line separator, so executors need no
file access of their own. Reading parses whole parts, and joins revisits to the responses they refer to.

Defined results: null html is an empty payload; a null page_id is written as an empty id and comes back null, and
is a response unless another page has its payload; rows that repeat the smallest page_id are all responses; a null
url becomes the record id; line breaks in a url are percent-encoded; other columns of pages are not archived.
"""

from __future__ import annotations

import gzip
import hashlib
import io

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .store import fresh_path

#: Smaller payloads are always written out.
LEAST_BYTES = 100
#: Records in an archive part; a part is what one reader holds.
PART_RECORDS = 1000
DATE = "2024-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_END = "\r\n\r\n"
_RECORDS = "page_id long, url string, record_type string, header_digest string, refers_to long, payload binary, payload_bytes long, payload_digest string"


def typed(pages: DataFrame, least: int = LEAST_BYTES) -> DataFrame:
    """page_id, url, payload (string), digest, payload_bytes, refers_to (null: response)."""
    payload = F.coalesce("html", F.lit(""))
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", payload.alias("payload"), F.sha2(payload, 256).alias("digest"), F.octet_length(payload).cast("long").alias("payload_bytes"))
    # partial aggregation leaves one header per task and digest, so a digest of very many pages meets in no one task
    first = rows.where(F.col("payload_bytes") >= least).groupBy("digest").agg(F.min("page_id").alias("__first"), F.count(F.lit(1)).alias("__n"))
    first = first.where("__n > 1 and __first is not null").select(F.col("digest").alias("__digest"), "__first")
    joined = rows.join(first, F.col("digest") == F.col("__digest"), "left")
    later = F.col("__first").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("__first"))
    return joined.select("page_id", "url", "payload", "digest", "payload_bytes", F.when(later, F.col("__first")).alias("refers_to"))


def write_archive(pages: DataFrame, path: str, least: int = LEAST_BYTES, date: str = DATE) -> None:
    """Write the archive of pages (page_id, url, html) below path."""
    rows = typed(pages, least)
    record_id = lambda c: F.concat(F.lit("<urn:page:"), F.coalesce(c.cast("string"), F.lit("")), F.lit(">"))
    own, revisit = record_id(F.col("page_id")), F.col("refers_to").isNotNull()
    url = F.regexp_replace(F.regexp_replace(F.coalesce(F.nullif("url", F.lit("")), F.substring_index(F.substring_index(own, "<", -1), ">", 1)), "\r", "%0D"), "\n", "%0A")
    http = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "), F.col("payload_bytes").cast("string"), F.lit(_END))
    block = F.when(revisit, http).otherwise(F.concat(http, "payload"))
    head = F.concat(
        F.lit("WARC/1.1\r\nWARC-Type: "), F.when(revisit, "revisit").otherwise("response"),
        F.lit("\r\nWARC-Record-ID: "), own, F.lit(f"\r\nWARC-Date: {date}\r\nWARC-Target-URI: "), url,
        F.lit("\r\nWARC-Payload-Digest: sha256:"), F.col("digest"),
        F.when(revisit, F.concat(F.lit(f"\r\nWARC-Profile: {PROFILE}\r\nWARC-Refers-To: "), record_id(F.col("refers_to")))).otherwise(""),
        F.lit("\r\nContent-Type: application/http; msgtype=response\r\nContent-Length: "), F.octet_length(block).cast("string"), F.lit(_END),
    )
    rows.select(F.concat(head, block).alias("value")).write.option("lineSep", _END).option("compression", "gzip").option("maxRecordsPerFile", PART_RECORDS).text(path)


def parse(stream: io.BufferedIOBase):
    """(headers, block) of each record of an archive stream."""
    while line := stream.readline():
        if not line.startswith(b"WARC/"):
            raise ValueError(f"not the start of a WARC record: {line[:40]!r}")
        headers = {}
        while (line := stream.readline()) not in (b"\r\n", b""):
            name, _, value = line.decode().partition(":")
            headers[name.strip().lower()] = value.strip()
        block = stream.read(n := int(headers["content-length"]))
        if len(block) != n or stream.read(4) != _END.encode():
            raise ValueError(f"record {headers.get('warc-record-id')} is cut short")
        yield headers, block


def _page(record_id: str | None) -> int | None:
    digits = (record_id or "").removeprefix("<urn:page:").removesuffix(">")
    return int(digits) if digits else None


def _records(with_payload: bool):
    def run(batches):
        for batch in batches:
            for content in batch.column("content"):
                rows = []
                for headers, block in parse(io.BufferedReader(gzip.GzipFile(fileobj=io.BytesIO(content.as_py())))):
                    response = headers["warc-type"] == "response"
                    payload = block.partition(_END.encode())[2] if response else None
                    rows.append({
                        "page_id": _page(headers["warc-record-id"]), "url": headers.get("warc-target-uri"), "record_type": headers["warc-type"],
                        "header_digest": headers["warc-payload-digest"].removeprefix("sha256:"), "refers_to": _page(headers.get("warc-refers-to")),
                        "payload": payload if with_payload else None, "payload_bytes": len(payload) if response else None,
                        "payload_digest": hashlib.sha256(payload).hexdigest() if response else None,
                    })
                types = [pa.int64(), pa.string(), pa.string(), pa.string(), pa.int64(), pa.binary(), pa.int64(), pa.string()]
                names = [x.split()[0] for x in _RECORDS.split(", ")]
                yield pa.RecordBatch.from_arrays([pa.array([r[n] for r in rows], t) for n, t in zip(names, types, strict=True)], names=names)

    return run


def read_archive(spark: SparkSession, path: str, with_payload: bool = True) -> DataFrame:
    """The records below path; payload, its bytes and its digest are null for revisits."""
    return spark.read.format("binaryFile").option("pathGlobFilter", "*.gz").load(path).select("content").mapInArrow(_records(with_payload), _RECORDS)


def resolve(records: DataFrame) -> DataFrame:
    """Records with every revisit given the payload facts (and payload, if read) of the response it refers to."""
    originals = records.where("record_type = 'response' and page_id is not null").groupBy(F.col("page_id").alias("__id"), F.col("payload_digest").alias("__digest")).agg(
        F.first("payload").alias("__payload"), F.first("payload_bytes").alias("__bytes")
    )
    joined = records.join(originals, (F.col("refers_to") == F.col("__id")) & (F.col("header_digest") == F.col("__digest")), "left")
    return joined.select(
        "page_id", "url", "record_type", "refers_to", F.coalesce("payload", "__payload").alias("payload"),
        F.coalesce("payload_bytes", "__bytes").alias("payload_bytes"), F.coalesce("payload_digest", "__digest").alias("payload_digest"),
    )


def report(pages: DataFrame) -> DataFrame:
    """Write the archive of pages, read it back and describe every record."""
    spark = pages.sparkSession
    path = fresh_path(spark, "warc")
    write_archive(pages, path)
    return resolve(read_archive(spark, path, with_payload=False)).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


#: The same rows in DuckDB.
ORACLE = """
WITH p AS (SELECT page_id, encode(coalesce(html, '')) AS b, sha256(encode(coalesce(html, ''))) AS digest FROM pages),
f AS (SELECT digest, min(page_id) AS first FROM p WHERE octet_length(b) >= 100 GROUP BY digest)
SELECT page_id, octet_length(b)::BIGINT AS payload_bytes, p.digest AS payload_digest,
       CASE WHEN first IS NOT NULL AND page_id <> first THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN page_id <> first THEN first END AS refers_to
FROM p LEFT JOIN f USING (digest)
"""
