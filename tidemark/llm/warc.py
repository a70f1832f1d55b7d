"""WARC archives: writing captures, reading records back, and transaction assembly (operator 2).

Writing: each page becomes a request, a response (or a revisit, if an equal payload is stored elsewhere) and
a metadata record; request and metadata name the response in ``WARC-Concurrent-To``. Every record is a gzip
member of its own. Spark's text sink writes the archives, so that they reach any file system Spark knows and
a retried task leaves nothing behind: the sink ends each row with one byte, and that is the last byte of the
row's last member, always zero (an empty member follows a record of 16 MB or more).

Reading: archives (gzip or plain) come as binary files and are cut into records by their lengths inside
tasks. ``max_captures`` a file bounds what a task holds. Assembly joins the three kinds of records by
identifier into one nested row a capture; payloads are only carried if asked for.

Nulls and edge cases: a null html is an empty payload; a null url or page id is left out of the headers and
read back as null. Of equal payloads of at least ``min_revisit_bytes``, rows with the least page id are
responses, also if that id is repeated; the others, null ids included, revisit it; equal payloads that all
lack an id are responses. Line ends and blanks in a url are percent-encoded. Very long pages are written
whole. Other columns are ignored; an empty table gives no archive records and an empty result.
"""

from __future__ import annotations

import hashlib
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import Scratch, table

MIN_REVISIT_BYTES = 100
MAX_CAPTURES = 4000
DATE = "2025-01-01T00:00:00Z"
# fixed value: the profile of a revisit with an equal payload
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_EMPTY_MEMBER = zlib.compress(b"", wbits=31)
_CHUNK = 1 << 14

RECORD_SCHEMA = ("record_id string, type string, concurrent_to string, target_uri string, date string, "
                 "payload_bytes long, payload_digest string, fields map<string,string>")


def _record(kind: str, record_id: str, headers: list[tuple[str, str | None]], block: bytes) -> bytes:
    lines = [("WARC-Type", kind), ("WARC-Record-ID", record_id), ("WARC-Date", DATE), *headers,
             ("Content-Length", str(len(block)))]
    head = "".join(f"{k}: {v}\r\n" for k, v in lines if v is not None)
    data = b"".join((b"WARC/1.1\r\n", head.encode(), b"\r\n", block, b"\r\n\r\n"))
    return zlib.compress(data, 1, wbits=31)


def _new_id() -> str:
    return f"<urn:uuid:{uuid.uuid4()}>"


def _safe_url(url: str | None) -> str | None:
    if url is None:
        return None
    return "".join(c if c > " " and c != "\x7f" else f"%{ord(c):02X}" for c in url)


def capture_bytes(page_id: int | None, url: str | None, html: bytes, digest: str, refers_to: int | None) -> bytes:
    """The gzip members of one capture; the last byte is zero."""
    url, response_id = _safe_url(url), _new_id()
    target = ("WARC-Target-URI", url)
    concurrent = ("WARC-Concurrent-To", response_id)
    request = _record("request", _new_id(), [target, concurrent, ("Content-Type", "application/http;msgtype=request")],
                      b"GET / HTTP/1.1\r\n\r\n")
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(html)
    about = [target, ("WARC-Payload-Digest", f"sha256:{digest}"), ("Content-Type", "application/http;msgtype=response")]
    if refers_to is None:
        main = _record("response", response_id, about, http + html)
    else:
        main = _record("revisit", response_id, [*about, ("WARC-Profile", REVISIT_PROFILE)], http)
    fields = {"page_id": page_id, "refers_to_page": refers_to}
    block = "".join(f"{k}: {v}\r\n" for k, v in fields.items() if v is not None).encode()
    metadata = _record("metadata", _new_id(), [target, concurrent, ("Content-Type", "application/warc-fields")], block)
    members = request + main + metadata
    return members if members[-1] == 0 else members + _EMPTY_MEMBER


def write_archives(pages: DataFrame, path: str, min_revisit_bytes: int = MIN_REVISIT_BYTES,
                   max_captures: int = MAX_CAPTURES) -> None:
    """Writes ``pages`` (page_id, url, html) as WARC files under ``path``."""
    payload = F.coalesce(F.col("html").cast("binary"), F.lit(b""))
    pages = pages.select("page_id", "url", payload.alias("html")).withColumn("digest", F.sha2("html", 256))
    firsts = (pages.where(F.octet_length("html") >= min_revisit_bytes).groupBy("digest")
              .agg(F.min("page_id").alias("first"), F.count("*").alias("n")).where("n > 1").select("digest", "first"))
    # AQE splits the partitions of a payload that very many pages have
    rows = pages.join(firsts, "digest", "left").select(
        "page_id", "url", "html", "digest",
        F.when(F.col("page_id").eqNullSafe(F.col("first")), None).otherwise(F.col("first")).alias("refers_to"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out, held = [], 0
            for row in zip(*batch.columns):
                page_id, url, html, digest, refers_to = row
                out.append(capture_bytes(page_id.as_py(), url.as_py(), html.as_py(), digest.as_py(), refers_to.as_py())[:-1])
                held += len(out[-1])
                if held > 1 << 22:
                    yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], names=["value"])
                    out, held = [], 0
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], names=["value"])

    (rows.mapInArrow(run, "value binary").select(F.col("value").cast("string").alias("value")).write
     .option("lineSep", "\x00").option("maxRecordsPerFile", max_captures).text(path))


def _inflated(data: memoryview) -> Iterator[bytes]:
    """Contents of an archive: of all gzip members in turn, or as it is if it isn't gzip."""
    if data[:2] != b"\x1f\x8b":
        yield bytes(data)
        return
    at = 0
    while at < len(data):
        member = zlib.decompressobj(wbits=31)
        while not member.eof:
            piece = data[at:at + _CHUNK]
            if not len(piece):
                raise ValueError("an archive ends inside a gzip member")
            yield member.decompress(piece)
            at += len(piece) - len(member.unused_data)


def records(data: memoryview) -> Iterator[tuple[dict[str, str], memoryview]]:
    """(headers by lower-case name, block) of each record of an archive, cut by Content-Length."""
    held = bytearray()
    pieces = _inflated(data)
    for piece in pieces:
        held += piece
        while True:
            end = held.find(b"\r\n\r\n")
            if end < 0:
                break
            lines = held[:end].decode("utf-8", "replace").split("\r\n")
            if not lines[0].startswith("WARC/"):
                raise ValueError(f"not a WARC record: {lines[0][:40]!r}")
            headers = {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines[1:])}
            size = int(headers["content-length"])
            while len(held) < end + 4 + size + 4:
                piece = next(pieces, None)
                if piece is None:
                    raise ValueError("an archive ends inside a record")
                held += piece
            yield headers, memoryview(bytes(held[end + 4:end + 4 + size]))
            del held[:end + 4 + size + 4]
    if held.strip():
        raise ValueError("an archive ends inside a record")


def _http_parts(block: memoryview) -> tuple[dict[str, str], memoryview]:
    head, _, _ = bytes(block[:65536]).partition(b"\r\n\r\n")
    lines = head.decode("utf-8", "replace").split("\r\n")
    return {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines[1:])}, block[len(head) + 4:]


def read_archives(spark: SparkSession, path: str, payload: bool = False) -> DataFrame:
    """One row per record of the archives under ``path`` (``RECORD_SCHEMA``, and ``payload`` if asked for).

    Of a response, length and digest are those of the payload as read; of a revisit, they are what its
    headers say of the payload it refers to.
    """

    def row(headers: dict[str, str], block: memoryview) -> tuple:
        kind, size, digest, fields, body = headers.get("warc-type"), None, None, None, None
        if kind == "response":
            _, body = _http_parts(block)
            size, digest = len(body), hashlib.sha256(body).hexdigest()
        elif kind == "revisit":
            http, _ = _http_parts(block)
            size = int(http["content-length"]) if "content-length" in http else None
            digest = headers.get("warc-payload-digest", "").rpartition(":")[2] or None
        elif kind == "metadata":
            lines = bytes(block).decode("utf-8", "replace").split("\r\n")
            fields = [(k.strip(), v.strip()) for k, sep, v in (x.partition(":") for x in lines) if sep]
        out = (headers.get("warc-record-id"), kind, headers.get("warc-concurrent-to"), headers.get("warc-target-uri"),
               headers.get("warc-date"), size, digest, fields)
        return (*out, bytes(body) if body is not None else None) if payload else out

    types = [pa.string()] * 5 + [pa.int64(), pa.string(), pa.map_(pa.string(), pa.string())] + [pa.binary()] * payload
    names = [x.split()[0] for x in RECORD_SCHEMA.split(", ")] + ["payload"] * payload

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in batch.column(0):
                out, held = [], 0
                for headers, block in records(memoryview(content.as_buffer()).cast("B")):
                    out.append(row(headers, block))
                    held += 500 + (len(block) if payload else 0)
                    if held > 1 << 23:
                        yield _batch(out, types, names)
                        out, held = [], 0
                yield _batch(out, types, names)

    files = spark.read.format("binaryFile").load(path).select("content")
    return files.mapInArrow(run, RECORD_SCHEMA + (", payload binary" if payload else ""))


def _batch(rows: list[tuple], types: list[pa.DataType], names: list[str]) -> pa.RecordBatch:
    columns = list(zip(*rows)) if rows else [[] for _ in types]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=names)


def assemble(found: DataFrame) -> DataFrame:
    """One nested row a capture: ``response`` (a response or revisit), ``request`` and ``metadata``, joined
    where their ``concurrent_to`` names the response. Of several requests or metadata records of a capture
    the one with the least identifier counts; a capture without one has null."""

    def part(kind: str) -> DataFrame:
        rows = found.where(F.col("type") == kind)
        return rows.groupBy("concurrent_to").agg(F.min_by(
            F.struct("record_id", "target_uri", "date", "fields"), "record_id").alias(kind))

    main = found.where(F.col("type").isin("response", "revisit"))
    main = main.select("record_id", F.struct(*[c for c in main.columns if c not in ("concurrent_to", "fields")]).alias("response"))
    for kind in ("request", "metadata"):
        main = main.join(part(kind), main["record_id"] == F.col("concurrent_to"), "left").drop("concurrent_to")
    return main.select("response", "request", "metadata")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    scratch = Scratch(spark, "warc")
    path = scratch.path("archives")
    write_archives(table(spark, sf_dir, "pages"), path)
    found = scratch.write(read_archives(spark, path), "records")
    fields = F.col("metadata.fields")
    return assemble(found).select(
        fields["page_id"].cast("long").alias("page_id"), F.col("response.payload_bytes").alias("payload_bytes"),
        F.col("response.payload_digest").alias("payload_digest"), F.col("response.type").alias("record_type"),
        fields["refers_to_page"].cast("long").alias("refers_to"))


ORACLE = """
WITH p AS (
  SELECT page_id, octet_length(encode(coalesce(html, ''))) AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest
  FROM pages),
f AS (SELECT payload_digest AS d, min(page_id) AS first FROM p WHERE payload_bytes >= 100 GROUP BY 1)
SELECT page_id, CAST(payload_bytes AS BIGINT) AS payload_bytes, payload_digest,
       CASE WHEN first IS NULL OR page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN first IS NULL OR page_id = first THEN NULL ELSE first END AS refers_to
FROM p LEFT JOIN f ON d = payload_digest
"""
