"""Legacy archives (ARC, versions 1 and 2) converted to WARC.

Archives are written by Spark's text writer, whose line separator is what ends a record in the format, and read as whole
files, so commits, retries and remote stores are Spark's. Each file is gzip-compressed as one stream.

- ARC: a version block, then records of one header line (5 fields in version 1, 10 in version 2), the declared number of
  bytes and a line break. Fields are taken from the right, because a URL may hold blanks.
- WARC: each record gets an identifier that follows from its content, the time of the ARC line, a block digest, a payload
  digest (base32 SHA-1), and its type: of records with equal payloads the one with the smallest key is ``response``, the
  others ``revisit`` it.

Defined results: a null payload is empty, a null key is kept as null and comes last, equal keys are ordered by their
place in the archive; a null URL is ``-``; blanks and control characters in URLs are percent-encoded; a short ARC date is
filled up; a record that ends before its declared length, or a header line without its fields, is an error.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import io
import re
import uuid

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

ARC_FIELDS = {
    1: "URL IP-address Archive-date Content-type Archive-length",
    2: "URL IP-address Archive-date Content-type Result-code Checksum Location Offset Filename Archive-length",
}
DATE = "20240101000000"
#: Payload bytes after which a reader hands on a batch.
BATCH_BYTES = 4 << 20
RECORD_END = "\r\n\r\n"


def digest(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


# Writing ARC


def raw(rows: list[bytes]) -> pa.RecordBatch:
    """Records for the text writer, which puts out the bytes of a value as they are, UTF-8 or not."""
    data = pa.array(rows, pa.binary())
    return pa.RecordBatch.from_arrays([pa.Array.from_buffers(pa.string(), len(data), data.buffers())], ["value"])


def version_block(version: int, name: str) -> bytes:
    body = f"{version} 0 panelspark\n{ARC_FIELDS[version]}\n"
    middle = "text/plain" if version == 1 else f"text/plain 200 - - 0 {name}"
    return f"filedesc://{name} 0.0.0.0 {DATE} {middle} {len(body)}\n{body}".encode()


def arc_record(version: int, key, url: str | None, payload: bytes, name: str) -> bytes:
    """One record: header line and an HTTP response; the writer adds the line break."""
    uri = re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url or "") or "-"
    head = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nX-Page-Id: {'' if key is None else key}\r\nContent-Length: {len(payload)}\r\n\r\n"
    length = len(head.encode()) + len(payload)
    middle = "text/html" if version == 1 else f"text/html 200 - - 0 {name}"
    return f"{uri} 0.0.0.0 {DATE} {middle} {length}\n{head}".encode() + payload


def write_arc(pages: DataFrame, path: str, key: str = "page_id", url: str = "url", payload: str = "html") -> None:
    """One archive for each partition, of version 1 and 2 by turns. Payloads are texts, kept as UTF-8, or bytes."""

    def run(batches):
        from pyspark import TaskContext

        part = TaskContext.get().partitionId()
        version, name, begun = 1 + part % 2, f"part-{part:05d}.arc", False
        for batch in batches:
            rows = [] if begun else [version_block(version, name)]
            begun, held = True, 0
            for k, u, p in zip(*(batch.column(c) for c in ("key", "url", "payload"))):
                rows.append(arc_record(version, k.as_py(), u.as_py(), p.as_py() or b"", name))
                held += len(rows[-1])
                if held > BATCH_BYTES:
                    yield raw(rows)
                    rows, held = [], 0
            yield raw(rows)

    rows = pages.select(F.col(key).cast("string").alias("key"), F.col(url).alias("url"), F.col(payload).cast("binary").alias("payload"))
    lines = rows.mapInArrow(run, "value string")
    lines.write.option("lineSep", "\n").option("compression", "gzip").text(path)


# Reading ARC


def arc_date(text: str) -> str:
    """The 14 digits as a WARC date; what is missing on the right is filled up."""
    d = text + "20000101000000"[len(text) :]
    return f"{d[:4]}-{d[4:6]}-{d[6:8]}T{d[8:10]}:{d[10:12]}:{d[12:14]}Z"


def arc_records(stream):
    """(offset, uri, ip, date, block) of each record of an archive, the version block apart."""
    version, offset = 1, 0
    while line := stream.readline():
        start, offset = offset, offset + len(line)
        if line in (b"\n", b"\r\n"):
            continue
        text = line.decode("utf-8", "replace").rstrip("\r\n")
        first = text.startswith("filedesc://")
        # The version block's own line has as many fields as its version says; its length comes last in both.
        fields = text.rsplit(" ", len(ARC_FIELDS[version].split()) - 1) if not first else text.split(" ")
        if len(fields) < 5 or not fields[-1].isdigit() or (not first and len(fields) != len(ARC_FIELDS[version].split())):
            raise ValueError(f"no ARC header line of version {version} at byte {start}")
        block = stream.read(int(fields[-1]))
        if len(block) != int(fields[-1]):
            raise ValueError(f"ARC record at byte {start} ends early")
        offset += len(block)
        if first:
            version = int(block.split(b" ", 1)[0])
            if version not in ARC_FIELDS:
                raise ValueError(f"ARC version {version} is unknown")
            continue
        yield start, fields[0], fields[1], arc_date(fields[2]), block


def split_http(block: bytes) -> tuple[bytes, bytes]:
    """The head of an HTTP message with its empty line, and the payload; no head if it is no such message."""
    if block.startswith(b"HTTP/") and (end := block.find(b"\r\n\r\n")) >= 0:
        return block[: end + 4], block[end + 4 :]
    return b"", block


def header_of(head: bytes, name: bytes) -> str | None:
    for line in head.split(b"\r\n")[1:]:
        if line.lower().startswith(name.lower() + b":"):
            return line.split(b":", 1)[1].strip().decode("utf-8", "replace")
    return None


def _files(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.format("binaryFile").load(path).select(F.element_at(F.split("path", "/"), -1).alias("name"), "content")


def read_arc(spark: SparkSession, path: str, with_block: bool = True) -> DataFrame:
    """The records of all archives in a folder, their payload digests and, if asked for, their blocks as text."""

    def run(batches):
        for batch in batches:
            for name, content in zip(batch.column("name").to_pylist(), batch.column("content")):
                rows, held = [], 0
                for offset, uri, ip, date, block in arc_records(gzip.GzipFile(fileobj=io.BytesIO(content.as_py()))):
                    head, payload = split_http(block)
                    key = header_of(head, b"X-Page-Id")
                    row = (name, offset, uri, ip, date, int(key) if key else None, len(payload), digest(payload))
                    rows.append(row + ((head, payload) if with_block else ()))
                    held += len(block)
                    if held > BATCH_BYTES:
                        yield _records(rows, names)
                        rows, held = [], 0
                yield _records(rows, names)

    names = ["file", "offset", "uri", "ip", "date", "key", "payload_bytes", "payload_digest"] + ["head", "payload"] * with_block
    kinds = "file string, offset long, uri string, ip string, date string, key long, payload_bytes long, payload_digest string"
    return _files(spark, path).mapInArrow(run, kinds + ", head binary, payload binary" * with_block)


ARROW = {"offset": pa.int64(), "key": pa.int64(), "payload_bytes": pa.int64(), "head": pa.binary(), "payload": pa.binary(), "refers_to": pa.int64()}


def _records(rows: list[tuple], names: list[str]) -> pa.RecordBatch:
    columns = list(zip(*rows)) if rows else [()] * len(names)
    return pa.RecordBatch.from_arrays([pa.array(c, ARROW.get(n, pa.string())) for n, c in zip(names, columns)], names)


# Writing and reading WARC


def record_id(uri: str, date: str, key, payload_digest: str, kind: str, offset: int) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{uri} {date} {key} {payload_digest} {kind} {offset}')}>"


def warc_record(r: dict) -> bytes:
    """Head and block of a record; the writer adds what ends it. A revisit keeps the HTTP head alone."""
    first = r["first"]
    response = first is None or (r["file"], r["offset"]) == (first["file"], first["offset"])
    head = r["head"] or b""
    block = head + (r["payload"] if response else b"")
    kind = "response" if response else "revisit"
    lines = [
        "WARC/1.1",
        f"WARC-Type: {kind}",
        f"WARC-Record-ID: {record_id(r['uri'], r['date'], r['key'], r['payload_digest'], kind, r['offset'])}",
        f"WARC-Date: {r['date']}",
        f"WARC-Target-URI: {r['uri']}",
        f"WARC-IP-Address: {r['ip']}",
        f"WARC-Payload-Digest: sha1:{r['payload_digest']}",
        f"WARC-Block-Digest: sha1:{digest(block)}",
        f"Content-Type: {'application/http; msgtype=response' if head else 'application/octet-stream'}",
    ]
    if not response:
        lines += [
            "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest",
            f"WARC-Refers-To: {record_id(first['uri'], first['date'], first['key'], r['payload_digest'], 'response', first['offset'])}",
            f"WARC-Refers-To-Target-URI: {first['uri']}",
            f"WARC-Refers-To-Date: {first['date']}",
            f"X-Refers-To-Page-Id: {'' if first['key'] is None else first['key']}",
        ]
    lines.append(f"Content-Length: {len(block)}")
    return ("\r\n".join(lines) + "\r\n\r\n").encode() + block


def convert(spark: SparkSession, arc: str, warc: str, least_bytes: int = 0) -> None:
    """Archives of the folder ``arc`` as WARC files in the folder ``warc``, byte for byte.

    The smallest key of each digest is found by an aggregation that combines before the shuffle; the records then meet it
    in a join that may split a digest with very many copies.
    """
    light = read_arc(spark, arc, with_block=False).filter(F.col("payload_bytes") >= least_bytes)
    order = F.struct(F.col("key").isNull().alias("none"), "key", "file", "offset", "uri", "date")
    firsts = light.groupBy("payload_digest").agg(F.min(order).alias("first"), F.count("*").alias("n")).filter("n > 1")
    rows = read_arc(spark, arc).join(firsts.select("payload_digest", "first"), "payload_digest", "left")

    def run(batches):
        for batch in batches:
            out, held = [], 0
            for r in batch.to_pylist():
                out.append(warc_record(r))
                held += len(out[-1])
                if held > BATCH_BYTES:
                    yield raw(out)
                    out, held = [], 0
            yield raw(out)

    lines = rows.mapInArrow(run, "value string")
    lines.write.option("lineSep", RECORD_END).option("compression", "gzip").text(warc)


def warc_records(stream):
    """(headers, block) of each record."""
    while line := stream.readline():
        if line == b"\r\n":
            continue
        if not line.startswith(b"WARC/"):
            raise ValueError("no WARC record where one should begin")
        headers = {}
        while (line := stream.readline()) not in (b"\r\n", b""):
            name, _, value = line.decode().partition(":")
            headers[name.strip().lower()] = value.strip()
        length = int(headers["content-length"])
        block = stream.read(length)
        if len(block) != length:
            raise ValueError("WARC record ends early")
        yield headers, block


def read_warc(spark: SparkSession, path: str) -> DataFrame:
    """Rows (uri, date, record_id, record_type, key, payload_bytes, payload_digest, refers_to, head, payload) of all
    records in a folder. Bytes and digest are those of the full payload, also of a revisit, which does not carry it."""

    def run(batches):
        for batch in batches:
            for content in batch.column("content"):
                rows, held = [], 0
                for h, block in warc_records(gzip.GzipFile(fileobj=io.BytesIO(content.as_py()))):
                    head, payload = split_http(block)
                    key, declared = header_of(head, b"X-Page-Id"), header_of(head, b"Content-Length")
                    full = len(payload) if h["warc-type"] == "response" else int(declared or 0)
                    to = h.get("x-refers-to-page-id")
                    digest_of = h["warc-payload-digest"].partition(":")[2]
                    rows.append((h["warc-target-uri"], h["warc-date"], h["warc-record-id"], h["warc-type"], int(key) if key else None, full, digest_of, int(to) if to else None, head, payload))
                    held += len(block)
                    if held > BATCH_BYTES:
                        yield _records(rows, names)
                        rows, held = [], 0
                yield _records(rows, names)

    names = ["uri", "date", "record_id", "record_type", "key", "payload_bytes", "payload_digest", "refers_to", "head", "payload"]
    kinds = "uri string, date string, record_id string, record_type string, key long, payload_bytes long, payload_digest string, refers_to long, head binary, payload binary"
    return _files(spark, path).mapInArrow(run, kinds)


#: What reading back gives, by SQL over the table of pages.
ORACLE = """
WITH p AS (
  SELECT page_id, coalesce(html, '') AS html, sha1(coalesce(html, '')) AS hex FROM pages
), firsts AS (
  SELECT page_id, html, hex, min(page_id) OVER (PARTITION BY hex) AS first FROM p
)
SELECT page_id, strlen(html)::BIGINT AS payload_bytes,
       array_to_string(list_transform(range(32), lambda k: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
         1 + (((('0x' || substr(hex, 5 * (k // 4) + 1, 5))::INTEGER >> (15 - 5 * (k % 4))::INTEGER) & 31)::INTEGER), 1)), '') AS payload_digest,
       CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> first THEN first END AS refers_to
FROM firsts
"""
