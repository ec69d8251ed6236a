"""WARC archives with revisit records, written and read by Spark.

Writing: headers (id, payload digest, size) are grouped by digest; of equal
payloads of at least `least` bytes the one with the smallest id is a response
record, the others are joined to it and become revisit records with fresh
headers and no payload. Records are the lines of Spark's text writer, whose
line separator is the empty lines that end a WARC record; so archives can go
to any store that Spark can write. Reading: whole files, cut by
Content-Length; revisits are resolved by a join of their digest to the
responses.

A null payload is an empty one. Rows that repeat the smallest id of a payload
are all responses; a null id refers to the smallest id of its payload, or is a
response where there is none. Control characters in addresses are
percent-encoded, so a header can't be broken by them.
"""

from __future__ import annotations

import gzip
import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

ENDS = "\r\n\r\n"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
#: records of one archive at most, which bounds what a reader holds
RECORDS = 5000


def resolved(pages: DataFrame, page_id: str = "page_id", payload: str = "html", least: int = 100) -> DataFrame:
    """All columns plus payload_bytes, payload_digest, record_type, refers_to."""
    body = F.coalesce(F.col(payload), F.lit(""))
    rows = pages.withColumns({"payload_bytes": F.octet_length(body).cast("bigint"), "payload_digest": F.sha2(body, 256)})
    first = (rows.where(F.col("payload_bytes") >= least).groupBy(F.col("payload_digest").alias("__digest"))
             .agg(F.min(page_id).alias("__first"), F.count(F.lit(1)).alias("__n")).where(F.col("__n") > 1))
    revisit = F.col("__first").isNotNull() & (F.col("payload_bytes") >= least) & ~F.col(page_id).eqNullSafe(F.col("__first"))
    return (rows.join(first, F.col("payload_digest") == F.col("__digest"), "left")
            .withColumns({"record_type": F.when(revisit, "revisit").otherwise("response"), "refers_to": F.when(revisit, F.col("__first"))})
            .drop("__digest", "__first", "__n"))


def write_archives(rows: DataFrame, path: str, page_id: str = "page_id", url: str = "url", payload: str = "html", date: str = "2024-01-01T00:00:00Z") -> None:
    """Rows of resolved() as gzip archives below `path`."""
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    name = lambda c: F.regexp_replace(F.sha2(F.concat(F.lit("record:"), F.coalesce(c.cast("string"), F.lit("null"))), 256), r"^(.{8})(.{4})(.{4})(.{4})(.{12}).*$", "<urn:uuid:$1-$2-$3-$4-$5>")
    target = F.regexp_replace(F.regexp_replace(F.regexp_replace(text(url), "\r", "%0D"), "\n", "%0A"), r"[\x00-\x20\x7f]", "%20")
    body = F.when(F.col("record_type") == "response", text(payload)).otherwise("")
    http = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "), F.col("payload_bytes").cast("string"), F.lit(ENDS))
    revisit = F.when(F.col("record_type") == "revisit", F.concat(F.lit(f"\r\nWARC-Profile: {PROFILE}\r\nWARC-Refers-To: "), name(F.col("refers_to")), F.lit("\r\nX-Refers-To-Id: "), F.col("refers_to").cast("string"))).otherwise("")
    own = F.when(F.col(page_id).isNotNull(), F.concat(F.lit("\r\nX-Source-Id: "), F.col(page_id).cast("string"))).otherwise("")
    record = F.concat(
        F.lit("WARC/1.1\r\nWARC-Type: "), F.col("record_type"), F.lit("\r\nWARC-Record-ID: "), name(F.col(page_id)), F.lit(f"\r\nWARC-Date: {date}\r\nWARC-Target-URI: "), target,
        F.lit("\r\nWARC-Payload-Digest: sha256:"), F.col("payload_digest"), revisit, own, F.lit("\r\nContent-Type: application/http; msgtype=response\r\nContent-Length: "),
        (F.octet_length(http) + F.octet_length(body)).cast("string"), F.lit(ENDS), http, body)
    rows.select(record.alias("value")).write.option("lineSep", ENDS).option("compression", "gzip").option("maxRecordsPerFile", RECORDS).text(path)


def records(data: bytes) -> Iterator[tuple[dict[str, str], memoryview]]:
    """(headers with lower-case names, payload) of each record of a file."""
    view, at = memoryview(data), 0
    while at < len(data):
        end = data.index(b"\r\n\r\n", at)
        lines = data[at:end].decode().split("\r\n")
        if lines[0] != "WARC/1.1":
            raise ValueError(f"no WARC record at byte {at}: {lines[0][:40]!r}")
        headers = {k.lower(): v for k, v in (x.split(": ", 1) if ": " in x else (x.rstrip(":"), "") for x in lines[1:])}
        start, length = end + 4, int(headers["content-length"])
        body = data.index(b"\r\n\r\n", start, start + length) + 4 if length else start
        yield headers, view[body : start + length]
        at = start + length + 4


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """(source_id, url, record_type, payload_digest, payload, payload_bytes,
    refers_to) of each record; a digest that doesn't fit the payload of a
    response is an error."""

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["source_id", "url", "record_type", "payload_digest", "payload", "payload_bytes", "refers_to"]
        types = [pa.int64(), pa.string(), pa.string(), pa.string(), pa.string(), pa.int64(), pa.int64()]
        number = lambda x: None if x is None else int(x)
        send = lambda rows: pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows) if rows else [[]] * len(types), types, strict=True)], names=names)
        for batch in batches:
            for content in batch.column(0):
                rows, size = [], 0
                for h, payload in records(gzip.decompress(content.as_py())):
                    kind, digest, blob = h["warc-type"], h["warc-payload-digest"].removeprefix("sha256:"), None
                    if kind == "response":
                        blob = bytes(payload)
                        if hashlib.sha256(blob).hexdigest() != digest:
                            raise ValueError(f"payload of {h['warc-record-id']} doesn't fit its digest")
                    rows.append((number(h.get("x-source-id")), h["warc-target-uri"], kind, digest, None if blob is None else blob.decode(), None if blob is None else len(blob), number(h.get("x-refers-to-id"))))
                    size += len(blob or b"")
                    if size > 1 << 22:
                        yield send(rows)
                        rows, size = [], 0
                yield send(rows)

    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.gz").load(path).select("content")
    return files.mapInArrow(parse, "source_id bigint, url string, record_type string, payload_digest string, payload string, payload_bytes bigint, refers_to bigint")


def resolve_revisits(found: DataFrame) -> DataFrame:
    """Fills payload_bytes of revisits from the response of their digest."""
    responses = (found.where("record_type = 'response'").groupBy(F.col("payload_digest").alias("__digest")).agg(F.max("payload_bytes").alias("__bytes")))
    revisits = found.where("record_type = 'revisit'").join(responses, F.col("payload_digest") == F.col("__digest"), "left")
    filled = revisits.withColumn("payload_bytes", F.col("__bytes")).select(*found.columns)
    return found.where("record_type = 'response'").unionByName(filled)
