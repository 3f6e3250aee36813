"""Legacy web archives (ARC) to WARC.

ARC files begin with a version block that names the fields of all header lines: version 1 has five, version 2 ten. Records
are read by those fields and their declared lengths. The converter makes what WARC needs and ARC lacks: record identifiers
(UUIDs of archive name, record number, URL and date, so reruns agree), ISO timestamps, record types (response for HTTP, resource for others, warcinfo for the
version block, revisit for a payload that another record has) and SHA-1 digests of block and payload.

Two passes over the archives: the first gathers digests and finds, by a partial aggregation, the first record of each payload
seen more than once; only that list is joined to the payloads, and broadcast while Spark's size threshold allows.

Files are written by Spark's text writer, whose lines are raw bytes here: the separator ends each record. Every scan partition
writes one gzipped file; readers get whole files, so a file's compressed size is bounded by the partition size.

Defined cases: null html is an empty payload; a null url becomes "unknown:"; a null page_id sorts last and stays null; repeated
rows are records of their own, and of equal page_ids the first in file order is the response; an empty table gives archives
with version blocks alone and an empty result; extra columns are ignored.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import io
import uuid
from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import kernels as K
from .shared import new_path, own_columns, written

#: The header fields of the two ARC versions.
FIELDS = {
    1: ["URL", "IP-address", "Archive-date", "Content-type", "Archive-length"],
    2: ["URL", "IP-address", "Archive-date", "Content-type", "Result-code", "Checksum", "Location", "Offset", "Filename", "Archive-length"],
}
KEY = "X-Record-Key"
DATE = "20240101000000"
ADDRESS = "0.0.0.0"  # noqa: S104
FLUSH = 8 << 20
SMALLEST_REVISIT = 0


def base32_sha1(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def _flushed(values: Iterator[bytes]) -> Iterator[pa.RecordBatch]:
    held, size = [], 0
    for v in values:
        held.append(v)
        size += len(v)
        if size >= FLUSH:
            yield pa.RecordBatch.from_arrays([pa.array(held, pa.binary())], names=["value"])
            held, size = [], 0
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(held, pa.binary())], names=["value"])


def _save(records: DataFrame, path: str, separator: str) -> None:
    records.select(F.col("value").cast("string")).write.option("lineSep", separator).option("compression", "gzip").option("zlib.compress.level", "BEST_SPEED").text(path)


def _files(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.format("binaryFile").load(path).select("path", "content")


# --- ARC


def _arc_line(version: int, url: str, mime: str, body: bytes, at: int, name: str) -> bytes:
    known = {"URL": url, "IP-address": ADDRESS, "Archive-date": DATE, "Content-type": mime, "Archive-length": str(len(body)), "Result-code": "200", "Checksum": base32_sha1(body), "Location": "-", "Offset": str(at), "Filename": name}
    return " ".join(known[f] for f in FIELDS[version]).encode()


def write_arc(pages: DataFrame, path: str) -> None:
    """pages (page_id, url, html) -> ARC files; odd partitions in version 2, even ones in version 1."""

    def records(batches: Iterator[pa.RecordBatch], part: int) -> Iterator[bytes]:
        version, name = 1 + part % 2, f"pages-{part:05d}.arc"
        block = f"{version} 0 pages\n{' '.join(FIELDS[version])}\n".encode()
        at = 0
        # the version block's own line has the five fields of version 1
        out = _arc_line(1, f"filedesc://{name}", "text/plain", block, at, name) + b"\n" + block
        yield out
        for batch in K.slices(batches, 2):
            for key, url, html in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                at += len(out) + 1
                body = (html or "").encode()
                head = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(body)}\r\n{KEY}: {'' if key is None else key}\r\n\r\n"
                body = head.encode() + body
                out = _arc_line(version, quote(url, safe="!#$%&'()*+,/:;=?@[]~-._") if url else "unknown:", "text/html", body, at, name) + b"\n" + body
                yield out

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from _flushed(records(batches, TaskContext.get().partitionId()))

    _save(pages.mapInArrow(scan, "value binary"), path, "\n")


def arc_records(content: bytes) -> Iterator[tuple[int, dict[str, str], bytes]]:
    """(number of the record, header fields, block); the first is the version block."""
    with gzip.GzipFile(fileobj=io.BytesIO(content)) as raw, io.BufferedReader(raw, 1 << 16) as file:
        number, fields = 0, FIELDS[1]
        while line := file.readline():
            if line == b"\n":  # between records
                continue
            values = line.decode().rstrip("\n").split(" ")
            if len(values) != len(fields):
                raise ValueError(f"ARC header with {len(values)} fields, {len(fields)} expected: {line[:200]!r}")
            head = dict(zip(fields, values, strict=True))
            block = file.read(int(head["Archive-length"]))
            if len(block) != int(head["Archive-length"]):
                raise ValueError(f"ARC record shorter than declared: {line[:200]!r}")
            yield number, head, block
            if number == 0:
                fields = FIELDS[int(block.split(b" ", 1)[0])]
            number += 1


def split_http(block: bytes) -> tuple[dict[str, str], bytes]:
    """HTTP headers (names in lower case) and payload."""
    head, _, body = block.partition(b"\r\n\r\n")
    lines = head.decode("latin-1").split("\r\n")[1:]
    return {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines)}, body


def _key(headers: dict[str, str]) -> int | None:
    value = headers.get(KEY.lower(), "")
    return int(value) if value else None


# --- conversion


def iso_date(date: str) -> str:
    date = date.ljust(14, "0")
    return f"{date[:4]}-{date[4:6]}-{date[6:8]}T{date[8:10]}:{date[10:12]}:{date[12:14]}Z"


def record_id(*parts: object) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, ' '.join(map(str, parts)))}>"


def warc_record(headers: list[tuple[str, object]], block: bytes) -> bytes:
    """Without the two line ends after the block: the writer's separator adds them."""
    lines = [*headers, ("WARC-Block-Digest", f"sha1:{base32_sha1(block)}"), ("Content-Length", len(block))]
    return b"WARC/1.0\r\n" + "".join(f"{k}: {v}\r\n" for k, v in lines).encode() + b"\r\n" + block


def _digests(spark: SparkSession, path: str) -> DataFrame:
    """(digest, size, key, path, number, archive, uri, date) of each HTTP record."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for file, content in zip(*batch.columns, strict=True):
                rows, archive = [], ""
                for number, head, block in arc_records(content.as_py()):
                    archive = archive if number else head["URL"].split("://")[-1]
                    if number and block.startswith(b"HTTP/"):
                        http, body = split_http(block)
                        rows.append((base32_sha1(body), len(body), _key(http), file.as_py(), number, archive, head["URL"], head["Archive-date"]))
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, kind) for c, kind in zip(zip(*rows, strict=True), KINDS, strict=True)], names=NAMES)

    NAMES = ["digest", "size", "key", "path", "number", "archive", "uri", "date"]
    KINDS = [pa.string(), pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.string()]
    return _files(spark, path).mapInArrow(scan, "digest string, size long, key long, path string, number long, archive string, uri string, date string")


def repeated_payloads(spark: SparkSession, path: str) -> DataFrame:
    """(digest, first): for payloads of several records, the record that stays a response."""
    first = F.min(F.struct(F.col("key").isNull().alias("no_key"), "key", "path", "number", "archive", "uri", "date")).alias("first")
    found = _digests(spark, path).where(F.col("size") >= SMALLEST_REVISIT).groupBy("digest").agg(first, F.count("*").alias("n"))
    return written(found.where("n > 1").select("digest", "first"), "archive-repeats")


def convert(spark: SparkSession, arc_path: str, warc_path: str) -> None:
    """ARC files -> WARC files."""
    repeats = repeated_payloads(spark, arc_path)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for file, content in zip(*batch.columns, strict=True):
                rows, size, archive = [], 0, ""
                for number, head, block in arc_records(content.as_py()):
                    archive = archive if number else head["URL"].split("://")[-1]
                    http, body = split_http(block) if number and block.startswith(b"HTTP/") else ({}, block)
                    rows.append((base32_sha1(body), file.as_py(), number, archive, head["URL"], head["IP-address"], head["Archive-date"], head["Content-type"], block))
                    size += len(block)
                    if size >= FLUSH:
                        yield batch_of(rows)
                        rows, size = [], 0
                if rows:
                    yield batch_of(rows)

    names = ["digest", "path", "number", "archive", "uri", "ip", "date", "mime", "block"]
    kinds = [pa.string(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.string(), pa.string(), pa.binary()]

    def batch_of(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, kind) for c, kind in zip(zip(*rows, strict=True), kinds, strict=True)], names=names)

    records = _files(spark, arc_path).mapInArrow(scan, "digest string, path string, number long, archive string, uri string, ip string, date string, mime string, block binary")
    same = (F.col("first.path") == F.col("path")) & (F.col("first.number") == F.col("number"))
    placed = records.join(repeats, "digest", "left").select(*names, F.when(~same, F.col("first")).alias("first"))

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from _flushed(to_warc(row) for batch in batches for one in K.slices(iter([batch]), 8) for row in one.to_pylist())

    _save(placed.mapInArrow(write, "value binary"), warc_path, "\r\n\r\n")


def to_warc(row: dict) -> bytes:
    date, block = iso_date(row["date"]), row["block"]
    mine = record_id(row["archive"], row["number"], row["uri"], row["date"])
    if row["number"] == 0:
        return warc_record([("WARC-Type", "warcinfo"), ("WARC-Record-ID", mine), ("WARC-Date", date), ("WARC-Filename", row["uri"].split("://")[-1]), ("Content-Type", "application/warc-fields")], b"software: arc converter\r\n" + b"".join(b"description: " + x + b"\r\n" for x in block.split(b"\n") if x))
    http = block.startswith(b"HTTP/")
    first = row["first"] if http else None
    head = [("WARC-Type", "revisit" if first else "response" if http else "resource"), ("WARC-Record-ID", mine), ("WARC-Date", date), ("WARC-Target-URI", row["uri"]), ("WARC-IP-Address", row["ip"]), ("WARC-Payload-Digest", f"sha1:{row['digest']}")]
    head.append(("Content-Type", "application/http; msgtype=response" if http else row["mime"]))
    if first:
        head += [
            ("WARC-Profile", "http://netpreserve.org/warc/1.0/revisit/identical-payload-digest"),
            ("WARC-Refers-To", record_id(first["archive"], first["number"], first["uri"], first["date"])),
            ("WARC-Refers-To-Target-URI", first["uri"]), ("WARC-Refers-To-Date", iso_date(first["date"])),
            ("X-Refers-To-Key", "" if first["key"] is None else first["key"]),
        ]
        block = block.partition(b"\r\n\r\n")[0] + b"\r\n\r\n"  # the HTTP headers stay, the payload doesn't
    return warc_record(head, block)


# --- WARC


def warc_records(content: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """(headers, block); checks the block's digest."""
    with gzip.GzipFile(fileobj=io.BytesIO(content)) as raw, io.BufferedReader(raw, 1 << 16) as file:
        while line := file.readline():
            if line == b"\r\n":
                continue
            if not line.startswith(b"WARC/"):
                raise ValueError(f"not a WARC record: {line[:200]!r}")
            headers = {}
            while (line := file.readline()) not in (b"\r\n", b""):
                name, _, value = line.decode().partition(":")
                headers[name.strip()] = value.strip()
            block = file.read(int(headers["Content-Length"]))
            if headers["WARC-Block-Digest"] != f"sha1:{base32_sha1(block)}":
                raise ValueError(f"block digest of {headers['WARC-Record-ID']} doesn't fit")
            yield headers, block


def read_warc(spark: SparkSession, path: str) -> DataFrame:
    """HTTP records of WARC files -> page_id, payload_bytes, payload_digest, record_type, refers_to, record_id, date, uri."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in batch.column(1):
                rows = []
                for head, block in warc_records(content.as_py()):
                    if head["WARC-Type"] not in ("response", "revisit"):
                        continue
                    http, body = split_http(block)
                    revisit = head["WARC-Type"] == "revisit"
                    digest = head["WARC-Payload-Digest"].removeprefix("sha1:") if revisit else base32_sha1(body)
                    if f"sha1:{digest}" != head["WARC-Payload-Digest"]:
                        raise ValueError(f"payload digest of {head['WARC-Record-ID']} doesn't fit")
                    refers = head.get("X-Refers-To-Key", "")
                    rows.append((_key(http), int(http["content-length"]) if revisit else len(body), digest, head["WARC-Type"], int(refers) if refers else None, head["WARC-Record-ID"], head["WARC-Date"], head["WARC-Target-URI"]))
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, kind) for c, kind in zip(zip(*rows, strict=True), KINDS, strict=True)], names=NAMES)

    NAMES = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "record_id", "date", "uri"]
    KINDS = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.string()]
    return _files(spark, path).mapInArrow(scan, "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, record_id string, date string, uri string")


def archived(pages: DataFrame) -> DataFrame:
    """pages (page_id, url, html) -> ARC -> WARC -> the records read back."""
    spark = pages.sparkSession
    arc, warc = new_path(spark, "arc"), new_path(spark, "warc")
    write_arc(own_columns(pages, ["page_id", "url", "html"]), arc)
    convert(spark, arc, warc)
    return read_warc(spark, warc)
