"""WARC archives as a chunked record table.

An archive is a table of (record_id, chunk, data): the header of a record, its payload in
pieces of at most CHUNK bytes, and its end. Data in the order of chunks is a WARC record
byte for byte. Every row carries the running CRC-32 and SHA-1 of the payload up to it, so a
reader checks a record as it streams by, and nothing ever holds more than one piece of it.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
from collections.abc import Iterator
from zlib import crc32

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .work import keyed, materialize, python_ready

#: Bytes of a payload piece, and least payload that revisits refer to.
CHUNK, LEAST_REVISIT = 64 << 10, 1000
DATE = "2024-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
CHUNKS = "record_id string, chunk long, data binary, crc long, digest string"
RECORDS = "record_id string, page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long"


def record_uri(row_id: str) -> str:
    return "urn:uuid:" + str(uuid.uuid5(uuid.NAMESPACE_OID, row_id))


def _line(text: str) -> str:
    return "".join(f"%{ord(c):02X}" if c in "\r\n" else c for c in text)


def record_rows(row_id: str, page_id, url, payload: memoryview, digest: str, refers_to, refers_row: str | None = None) -> Iterator[tuple]:
    """The chunk rows of one record; ``digest`` is the SHA-1 of the payload, as bare hex, ``refers_row`` the row of refers_to."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    revisit = refers_to is not None
    head = ["WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}", f"WARC-Record-ID: <{record_uri(row_id)}>", f"WARC-Date: {DATE}"]
    head += [f"WARC-Target-URI: {_line(url)}"] if url else []
    head += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: <{record_uri(refers_row)}>", f"X-Refers-To-Page: {refers_to}"] if revisit else []
    head += [f"X-Page: {page_id}"] if page_id is not None else []
    head += ["WARC-Payload-Digest: sha1:" + base64.b32encode(bytes.fromhex(digest)).decode(), "Content-Type: application/http; msgtype=response", f"Content-Length: {len(http) + (0 if revisit else len(payload))}"]
    sha, crc = hashlib.sha1(), 0
    yield row_id, 0, ("\r\n".join(head) + "\r\n\r\n").encode() + http, 0, sha.hexdigest()
    n = 1
    for at in range(0, 0 if revisit else len(payload), CHUNK):
        piece = payload[at : at + CHUNK]
        sha.update(piece)
        crc = crc32(piece, crc)
        yield row_id, n, bytes(piece), crc, sha.hexdigest()
        n += 1
    yield row_id, n, b"\r\n\r\n", crc, sha.hexdigest()


def read_records(rows: Iterator[tuple]) -> Iterator[tuple]:
    """Records from chunk rows that come in order; raises where a check fails."""
    now = None
    for row_id, chunk, data, crc, digest in rows:
        if chunk == 0:
            if now is not None:
                raise ValueError(f"record {now['id']} does not end")
            head, _, http = bytes(data).partition(b"\r\n\r\n")
            field = dict(x.split(": ", 1) for x in head.decode().split("\r\n")[1:])
            size = dict(x.split(": ", 1) for x in http.decode().split("\r\n")[1:] if x)["Content-Length"]
            now = {"id": row_id, "field": field, "left": int(field["Content-Length"]) - len(http), "size": int(size), "sha": hashlib.sha1(), "crc": 0, "next": 1}
            continue
        if now is None or now["id"] != row_id or now["next"] != chunk:
            raise ValueError(f"record {row_id} lacks a chunk before {chunk}")
        now["next"] += 1
        if now["left"]:
            now["sha"].update(data)
            now["crc"] = crc32(data, now["crc"])
            now["left"] -= len(data)
            if now["left"] < 0 or now["crc"] != crc or now["sha"].hexdigest() != digest:
                raise ValueError(f"record {row_id} is damaged at chunk {chunk}")
            continue
        field, kind = now["field"], now["field"]["WARC-Type"]
        named = base64.b32decode(field["WARC-Payload-Digest"].removeprefix("sha1:")).hex()
        if bytes(data) != b"\r\n\r\n" or kind == "response" and now["sha"].hexdigest() != named:
            raise ValueError(f"record {row_id} does not match its digest")
        page, to = field.get("X-Page"), field.get("X-Refers-To-Page")
        yield row_id, None if page is None else int(page), now["size"], named, kind, None if to is None else int(to)
        now = None
    if now is not None:
        raise ValueError(f"record {now['id']} does not end")


def _batches(rows: Iterator[tuple], schema: pa.Schema, size: int = 256) -> Iterator[pa.RecordBatch]:
    part: list[tuple] = []
    held = 0
    for row in rows:
        part.append(row)
        held += len(row[2]) if isinstance(row[2], bytes) else 0
        if len(part) >= size or held >= 8 << 20:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*part, strict=True), schema, strict=True)], schema=schema)
            part, held = [], 0
    if part:
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*part, strict=True), schema, strict=True)], schema=schema)


_CHUNK_SCHEMA = pa.schema([("record_id", pa.string()), ("chunk", pa.int64()), ("data", pa.binary()), ("crc", pa.int64()), ("digest", pa.string())])
_RECORD_SCHEMA = pa.schema([("record_id", pa.string()), ("page_id", pa.int64()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64())])


def write_archive(pages: DataFrame) -> DataFrame:
    """The chunk table of an archive with one record for each row of ``pages``.

    Of rows with equal payloads (html in UTF-8, null as empty) of at least LEAST_REVISIT
    bytes, those that bear the greatest page_id are responses and others revisit it; smaller
    payloads and rows of null page_id are responses. Null urls are left out. Columns other
    than page_id, url and html are ignored; rows that repeat are records of their own.

    A row's identifier is its page_id and its place in the scan of ``pages``, so it is the same
    whenever the same files are read; the archive is written once before it is read.
    """
    python_ready(pages.sparkSession)
    body = F.coalesce(F.col("html"), F.lit("")).cast("binary")
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), body.alias("body")).withColumn("digest", F.sha1("body"))
    rows = rows.withColumn("row_id", F.concat_ws("-", F.coalesce(F.col("page_id").cast("string"), F.lit("none")), F.monotonically_increasing_id().cast("string")))
    large = rows.where(F.octet_length("body") >= LEAST_REVISIT).groupBy("digest").agg(F.max(F.when(F.col("page_id").isNotNull(), F.struct("page_id", "row_id"))).alias("newest"), F.count("*").alias("rows"))
    twice = materialize(large.where("rows > 1 and newest is not null").select("digest", F.col("newest.page_id").alias("newest"), F.col("newest.row_id").alias("newest_row"), "rows"), "equal")
    rows = keyed(rows, twice, "digest", 160)
    older = F.col("page_id") < F.col("newest")
    rows = rows.select("row_id", "page_id", "url", "body", "digest", F.when(older, F.col("newest")).alias("refers_to"), F.when(older, F.col("newest_row")).alias("refers_row"))

    def write(batches):
        def records():
            for b in batches:
                body = b.column(3)
                for i, (r, p, u, d, to, row) in enumerate(zip(*(b.column(k).to_pylist() for k in (0, 1, 2, 4, 5, 6)), strict=True)):
                    yield from record_rows(r, p, u, memoryview(body[i].as_buffer()), d, to, row)

        yield from _batches(records(), _CHUNK_SCHEMA)

    return rows.mapInArrow(write, CHUNKS)


def read_archive(chunks: DataFrame) -> DataFrame:
    """One row for each record of a chunk table: page_id, sizes, digest, type, refers_to."""
    python_ready(chunks.sparkSession)

    def read(batches):
        def rows():
            for b in batches:
                ids, n, data, crc, digest = (b.column(k) for k in range(5))
                for i in range(len(b)):
                    yield ids[i].as_py(), n[i].as_py(), memoryview(data[i].as_buffer()), crc[i].as_py(), digest[i].as_py()

        yield from _batches(read_records(rows()), _RECORD_SCHEMA)

    ordered = chunks.repartition("record_id").sortWithinPartitions("record_id", "chunk")
    return ordered.mapInArrow(read, RECORDS)


def archived(pages: DataFrame) -> DataFrame:
    """Write ``pages`` as an archive into the shared work folder, and read its records."""
    return read_archive(materialize(write_archive(pages), "warc")).drop("record_id")


ORACLE = f"""
WITH p AS (SELECT page_id, coalesce(html, '') AS b FROM pages),
q AS (SELECT page_id, strlen(b)::BIGINT AS payload_bytes, sha1(b) AS payload_digest FROM p),
m AS (SELECT *, max(page_id) OVER (PARTITION BY payload_digest, payload_bytes) AS newest FROM q)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN payload_bytes >= {LEAST_REVISIT} AND page_id < newest THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN payload_bytes >= {LEAST_REVISIT} AND page_id < newest THEN newest END AS refers_to FROM m
"""
