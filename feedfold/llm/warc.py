"""WARC transactions: request, response or revisit, and metadata records, written to archives, read back and assembled.

A capture is three records; request and metadata name the response or revisit in WARC-Concurrent-To. Archives are
text files of Spark's writer whose separator is the blank line that ends a WARC record, so each file is a valid sequence of
records, gzipped as a whole. Readers go by Content-Length, never by searching for separators.
"""

from __future__ import annotations

import gzip
import hashlib
import io
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from feedfold.llm.common import join_spread, stage, with_group
from feedfold.session import scratch_path

LEAST_BYTES = 100
ARCHIVE_BYTES = 64 << 20
#: Fixed: parts of the format.
CRLF = "\r\n"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
RECORD = "type string, record_id string, concurrent_to string, refers_to string, target_uri string, payload_digest string, page string, payload_bytes long, payload_sha256 string, payload string"


def _uuid(*parts: Column) -> Column:
    h = F.sha2(F.concat_ws("|", *parts), 256)
    return F.concat(F.lit("<urn:uuid:"), *(x for i, (at, n) in enumerate(((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))) for x in ([F.lit("-")] if i else []) + [F.substring(h, at, n)]), F.lit(">"))


def _record(kind: str | Column, headers: list[tuple[str, Column]], mime: str, block: Column) -> Column:
    kind = F.lit(kind) if isinstance(kind, str) else kind
    lines = [F.concat(F.lit(f"{name}: "), value) for name, value in headers]
    length = F.octet_length(block).cast("string")
    head = F.concat_ws(CRLF, F.lit("WARC/1.1"), F.concat(F.lit("WARC-Type: "), kind), *lines, F.lit(f"Content-Type: {mime}"), F.concat(F.lit("Content-Length: "), length))
    return F.concat(head, F.lit(CRLF * 2), block)


def captures(pages: DataFrame, archives: int) -> DataFrame:
    """page_id, url, payload, digest, first (page_id of the record it revisits, else null) and copy (0, 1, ... among rows that repeat a
    page and payload) of every row of pages, dealt to archives.

    Only a narrow list of repeated payloads, salted by page_id, is joined to the pages, whose payloads are shuffled once, to the place
    where they are written. A payload that many pages share is spread over these pages.
    """
    payload = F.coalesce("html", F.lit(""))
    rows = pages.select("page_id", "url", payload.alias("payload"), F.sha2(payload, 256).alias("digest"))
    narrow = pages.where(F.octet_length(payload) >= LEAST_BYTES).select("page_id", F.sha2(payload, 256).alias("digest"))
    led = with_group(narrow.distinct(), ["digest"], ["page_id"], {"first": F.min("page_id")})
    keys = ["page_id", "digest"]
    later = led.where("first <> page_id").select(*keys, "first")
    met = rows.repartition(archives, *keys).join(later.repartition(archives, *keys).hint("merge"), keys, "left")
    return met.withColumn("copy", F.row_number().over(Window.partitionBy(*keys).orderBy("first")) - 1)


def write_archives(pages: DataFrame, path: str, archive_bytes: int = ARCHIVE_BYTES) -> None:
    """Three records per row of pages, gzipped, in archives of about archive_bytes before compression.

    Archives also end after as many records as make archive_bytes on average, so rows that repeat one page and payload, which one task writes
    one by one, fill several.
    """
    total, count = pages.agg(F.sum(F.octet_length("html")), F.count("*")).first()
    archives = max(1, -(-(total or 0) // archive_bytes))
    uri = F.regexp_replace(F.coalesce("url", F.lit("")), r"[\r\n]", "%0A")
    page = F.coalesce(F.col("page_id").cast("string"), F.lit(""))
    own = captures(pages, archives)
    # named by page and payload; rows that repeat it by their number as well
    named = lambda page, copy: _uuid(page, F.col("digest"), copy.cast("string"))
    main = named(page, F.col("copy"))
    is_copy = F.col("first").isNotNull()
    digest = F.concat(F.lit("sha256:"), "digest")
    http = F.concat(F.lit(f"HTTP/1.1 200 OK{CRLF}Content-Type: text/html; charset=utf-8{CRLF}Content-Length: "), F.octet_length("payload").cast("string"), F.lit(CRLF * 2))
    common = [("WARC-Target-URI", uri), ("WARC-Date", F.lit("2024-01-01T00:00:00Z"))]
    revisit = [("WARC-Profile", F.lit(PROFILE)), ("WARC-Refers-To", named(F.col("first").cast("string"), F.lit(0))), ("WARC-Truncated", F.lit("length"))]
    fixed = [("WARC-Record-ID", main), *common, ("WARC-Payload-Digest", digest)]
    body = F.when(is_copy, _record("revisit", fixed + revisit, "application/http; msgtype=response", http)).otherwise(
        _record("response", fixed, "application/http; msgtype=response", F.concat(http, "payload"))
    )
    ask = _record("request", [("WARC-Record-ID", _uuid(F.lit("request"), main)), ("WARC-Concurrent-To", main), *common], "application/http; msgtype=request", F.concat(F.lit("GET "), uri, F.lit(f" HTTP/1.1{CRLF * 2}")))
    note = _record("metadata", [("WARC-Record-ID", _uuid(F.lit("metadata"), main)), ("WARC-Concurrent-To", main), *common], "application/warc-fields", F.concat(F.lit("page: "), page, F.lit(CRLF)))
    records = own.select(F.explode(F.array(ask, body, note)).alias("value")).write.option("lineSep", CRLF * 2).option("compression", "gzip")
    records.option("maxRecordsPerFile", 6 * max(1, -(-count // archives))).text(path)


def _records(data: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """Header fields (names in lower case) and block of each record of an archive, gzipped as a whole or record by record, by their Content-Length."""
    stream = io.BufferedReader(gzip.GzipFile(fileobj=io.BytesIO(data)), 1 << 20)
    while line := stream.readline():
        if not line.strip():
            continue
        fields = {}
        while line.strip():
            name, _, value = line.decode("utf-8", "replace").partition(":")
            fields[name.strip().lower()] = value.strip()
            line = stream.readline()
        yield fields, stream.read(int(fields["content-length"]))


def read_archives(spark: SparkSession, path: str, payloads: bool = True) -> DataFrame:
    """One row per record. A response has length and SHA-256 of its payload as found, and with payloads the payload itself; a revisit
    the length that its HTTP head states."""

    def row(f: dict[str, str], block: bytes) -> dict:
        kind, out = f.get("warc-type"), {}
        if kind in ("response", "revisit"):
            head, _, payload = block.partition(b"\r\n\r\n")
            said = [x.partition(b":")[2] for x in head.split(b"\r\n") if x.lower().startswith(b"content-length:")]
            if kind == "response":
                out = {"payload_bytes": len(payload), "payload_sha256": hashlib.sha256(payload).hexdigest(), "payload": payload.decode("utf-8", "replace") if payloads else None}
            else:
                out = {"payload_bytes": int(said[0]) if said else None, "payload_sha256": f.get("warc-payload-digest", "").removeprefix("sha256:")}
        elif kind == "metadata":
            out = {"page": next((x[5:].strip() for x in block.decode().split(CRLF) if x.startswith("page:")), None)}
        names = {"record_id": "warc-record-id", "concurrent_to": "warc-concurrent-to", "refers_to": "warc-refers-to", "target_uri": "warc-target-uri", "payload_digest": "warc-payload-digest"}
        return {"type": kind, **{k: f.get(v) for k, v in names.items()}, **out}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([(n, pa.int64() if t == "long" else pa.string()) for n, t in (x.split() for x in RECORD.split(", "))])
        for batch in batches:
            for i in range(batch.num_rows):
                held, size = [], 0
                for f, block in _records(batch.column(0)[i].as_py()):
                    held.append(row(f, block))
                    size += len(block)
                    if size > 4 << 20:
                        yield pa.RecordBatch.from_pylist(held, schema)
                        held, size = [], 0
                yield pa.RecordBatch.from_pylist(held, schema)

    return spark.read.format("binaryFile").load(path).select("content").mapInArrow(run, RECORD)


def assemble(records: DataFrame) -> DataFrame:
    """One nested row per capture: page, capture (the response or revisit), request, metadata; joined by WARC-Concurrent-To.

    A capture without request or metadata has null there. Record ids are unique, so no join meets a hot key.
    """
    fields = [c for c in records.columns if c not in ("concurrent_to", "type")]
    main = records.where("type IN ('response', 'revisit')").select(F.col("record_id").alias("id"), F.struct("type", *fields).alias("capture"))
    side = ("record_id", "target_uri", "page")
    ask = records.where("type = 'request'").select(F.col("concurrent_to").alias("id"), F.struct(*side).alias("request"))
    note = records.where("type = 'metadata'").select(F.col("concurrent_to").alias("id"), F.struct(*side).alias("metadata"))
    return main.join(ask, "id", "left").join(note, "id", "left").select(F.nullif(F.col("metadata.page"), F.lit("")).alias("page"), "capture", "request", "metadata")


def resolve(assembled: DataFrame) -> DataFrame:
    """assemble()'s rows with refers_to_page, the page of the response that a revisit's WARC-Refers-To names; null for others.

    Any number of revisits may name one response, so they are spread over salts, to which it goes.
    """
    narrow = stage(assembled, "captures")
    responses = narrow.where("capture.type = 'response'").select(F.col("capture.record_id").alias("target"), F.col("page").alias("refers_to_page"))
    revisits = narrow.where("capture.type = 'revisit'").select("*", F.col("capture.refers_to").alias("target"), F.col("capture.record_id").alias("own"))
    met = join_spread(revisits, responses, ["target"], ["own"]).select(*narrow.columns, "refers_to_page")
    return narrow.where("capture.type = 'response'").withColumn("refers_to_page", F.lit(None).cast("string")).unionByName(met)


def round_trip(pages: DataFrame) -> DataFrame:
    """page_id, payload_bytes, payload_digest, record_type, refers_to: archives of pages written, read back and assembled.

    A null html is an empty payload, a null url an empty target. A row that repeats a page_id and payload is a capture of its own of
    the same type; a null page_id stays null and nothing refers to it. An empty table gives no rows.
    """
    spark = pages.sparkSession
    path = scratch_path(spark, "llm-warc")
    write_archives(pages, path)
    found = resolve(assemble(stage(read_archives(spark, path, payloads=False), "records")))
    kind = pages.schema["page_id"].dataType
    return found.select(
        F.col("page").cast(kind).alias("page_id"),
        F.col("capture.payload_bytes").alias("payload_bytes"),
        F.col("capture.payload_sha256").alias("payload_digest"),
        F.col("capture.type").alias("record_type"),
        F.col("refers_to_page").cast(kind).alias("refers_to"),
    )


ORACLE = """
WITH p AS (
  SELECT page_id, coalesce(html, '') AS body, octet_length(encode(coalesce(html, ''))) AS n FROM pages),
g AS (SELECT page_id, n, body, CASE WHEN n >= 100 THEN min(page_id) OVER (PARTITION BY body) ELSE page_id END AS first FROM p)
SELECT page_id, n AS payload_bytes, sha256(body) AS payload_digest,
       CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> first THEN first END AS refers_to
FROM g"""
