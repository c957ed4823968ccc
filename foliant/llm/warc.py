"""Legacy web archives (ARC, versions 1 and 2) and their conversion to WARC.

``write_arc`` and ``write_warc`` lay records down with Spark's text writer: a
row is a record, the line separator is the format's own separator, so the files
are archives in the shared folder, written again from their inputs if a task is
lost.  Pages are written apart by their size, and files of pages of at most
``PAGE_BYTES << c`` bytes hold at most ``FILE_RECORDS >> c`` records, so a file has
some 64 MB before compression, or one record: that is what a reader holds at
once.  Readers follow the declared lengths byte by byte.
"""

from __future__ import annotations

import gzip
import hashlib
import uuid

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import bounded, fresh, written

FILE_RECORDS, PAGE_BYTES = 4096, 16 << 10
HELD_BYTES = 4 << 20
REVISIT_BYTES = 100
ARCHIVED = "20240101000000"
# The fields of an ARC record's header line, by version.
ARC_FIELDS = {
    1: ["URL", "IP-address", "Archive-date", "Content-type", "Archive-length"],
    2: ["URL", "IP-address", "Archive-date", "Content-type", "Result-code", "Checksum", "Location", "Offset", "Filename", "Archive-length"],
}
SPACE = uuid.UUID("6ba7b811-9dad-11d1-80b4-00c04fd430c8")


def _head(version: int, name: str, offset: int = 0) -> str:
    """The version block that opens an ARC file."""
    body = f"{version} 0 foliant\n{' '.join(ARC_FIELDS[version])}\n"
    tail = f" 200 - - {offset} {name}" if version == 2 else ""
    return f"filedesc://{name} 0.0.0.0 {ARCHIVED} text/plain{tail} {len(body.encode())}\n{body}"


def _sized(rows: DataFrame, size) -> list[tuple[DataFrame, int]]:
    """The rows by size class, and how many of them a file holds; of no rows, one class."""
    grade = F.when(size <= PAGE_BYTES, F.lit(0)).otherwise(F.ceil(F.log2(size / PAGE_BYTES))).cast("int")
    grade = F.coalesce(grade, F.lit(0))
    grades = [c for (c,) in sorted(rows.select(grade).distinct().collect())]
    return [(rows.where(grade == c) if len(grades) > 1 else rows, max(1, FILE_RECORDS >> c)) for c in grades or [0]]


def _laid(rows: DataFrame, folder: str, separator: str, most: int) -> None:
    rows.write.mode("append").option("lineSep", separator).option("maxRecordsPerFile", most).option("compression", "gzip").text(folder)


def _http(page: int | None, size: int) -> str:
    return f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nX-Page-Id: {'-' if page is None else page}\r\nContent-Length: {size}\r\n\r\n"


def write_arc(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> str:
    """Writes ARC files, version 1 and 2 by turns, one record per row; their folder."""

    def run(batches, most):
        part = TaskContext.get().partitionId()
        version, name, seen = 1 + part % 2, f"part-{part:06d}.arc", 0
        for batch in batches:
            out, held = [], 0
            for page, url, html in zip(*batch.columns):
                page, url, html = page.as_py(), url.as_py(), html.as_py()
                if seen % most == 0:
                    out.append(_head(version, name))
                    seen += 1
                raw = (html or "").encode()
                doc = _http(page, len(raw)) + (html or "")
                url = "%20".join((url or "about:blank").split()) or "about:blank"
                extra = f" 200 {hashlib.md5(raw).hexdigest()} - {seen} {name}" if version == 2 else ""
                out.append(f"{url} 0.0.0.0 {ARCHIVED} text/html{extra} {len(doc.encode())}\n{doc}")
                seen += 1
                held += len(raw)
                if held > HELD_BYTES:
                    yield pa.RecordBatch.from_arrays([pa.array(out, pa.string())], ["value"])
                    out, held = [], 0
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.string())], ["value"])

    bounded(pages.sparkSession)
    folder = fresh(pages.sparkSession, "arc")
    pages = pages.select(F.col(id_col).cast("long").alias("page"), F.col(url_col).cast("string").alias("url"), F.col(html_col).cast("string").alias("html"))
    for rows, most in _sized(pages, F.octet_length("html")):
        _laid(rows.mapInArrow(lambda b, most=most + 1: run(b, most), "value string"), folder, "\n", most + 1)
    return folder


def arc_records(raw: bytes):
    """(fields, document) of each record but the version blocks, by the version that its file or its own header line declares."""
    at, fields = 0, None
    while at < len(raw):
        if raw[at : at + 1] in (b"\n", b"\r"):
            at += 1
            continue
        end = raw.index(b"\n", at)
        line = raw[at:end].decode().rstrip("\r").split(" ")
        size = int(line[-1])
        body = raw[end + 1 : end + 1 + size]
        if len(body) != size:
            raise ValueError(f"an ARC record is cut short: {size} bytes declared, {len(body)} there")
        at = end + 1 + size
        if line[0].startswith("filedesc://"):
            fields = ARC_FIELDS[int(body.split(b" ", 1)[0])]
            continue
        names = fields if fields and len(fields) == len(line) else ARC_FIELDS[1 if len(line) == 5 else 2]
        yield dict(zip(names, line)), body


def _opened(content: bytes) -> bytes:
    return gzip.decompress(content) if content[:2] == b"\x1f\x8b" else content


def convert_arc(spark, folder: str) -> DataFrame:
    """ARC files as WARC material: (page_id, uri, date, record_id, http, payload, bytes, digest)."""

    def run(batches):
        for batch in batches:
            for content in batch.column(0):
                out: list[list] = [[] for _ in range(8)]
                held = 0
                for fields, doc in arc_records(_opened(content.as_py())):
                    http, _, payload = doc.partition(b"\r\n\r\n")
                    page = next((x.split(b": ", 1)[1].decode() for x in http.split(b"\r\n") if x.startswith(b"X-Page-Id: ")), "-")
                    d = fields["Archive-date"]
                    date = f"{d[:4]}-{d[4:6]}-{d[6:8]}T{d[8:10]}:{d[10:12]}:{d[12:14]}Z"
                    digest = hashlib.sha256(payload).hexdigest()
                    name = uuid.uuid5(SPACE, f"{fields['URL']} {date} {page} {digest}")
                    row = (None if page == "-" else int(page), fields["URL"], date, f"<urn:uuid:{name}>", http.decode(), payload.decode(), len(payload), digest)
                    for o, v in zip(out, row):
                        o.append(v)
                    held += len(payload)
                    if held > HELD_BYTES:
                        yield _rows(out)
                        out, held = [[] for _ in range(8)], 0
                yield _rows(out)

    schema = "page_id long, uri string, date string, record_id string, http string, payload string, bytes long, digest string"
    return spark.read.format("binaryFile").load(folder).select("content").mapInArrow(run, schema)


def _rows(out):
    types = [pa.int64(), *[pa.string()] * 5, pa.int64(), pa.string()]
    return pa.RecordBatch.from_arrays([pa.array(o, t) for o, t in zip(out, types)], ["page_id", "uri", "date", "record_id", "http", "payload", "bytes", "digest"])


def _read_rows(out):
    types = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string()]
    return pa.RecordBatch.from_arrays([pa.array(o, t) for o, t in zip(out, types)], ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "payload"])


def write_warc(records: DataFrame) -> str:
    """Writes WARC files: of equal payloads of ``REVISIT_BYTES`` or more, the smallest page is a response, the others revisit it."""
    order = F.coalesce("page_id", F.lit(2**63 - 1))
    first = records.where(F.col("bytes") >= REVISIT_BYTES).groupBy(F.col("digest").alias("own")).agg(F.min(order).alias("first"), F.min_by("record_id", order).alias("target"), F.count("*").alias("c"))
    first = written(first.where("c > 1").drop("c"), "first")
    joined = records.join(first, (F.col("digest") == F.col("own")) & (F.col("bytes") >= REVISIT_BYTES), "left")
    revisit = F.coalesce(F.col("first") < order, F.lit(False))
    block = F.concat(F.col("http"), F.lit("\r\n\r\n"), F.when(revisit, F.lit("")).otherwise(F.col("payload")))
    lines = [
        F.lit("WARC/1.1"),
        F.concat(F.lit("WARC-Type: "), F.when(revisit, F.lit("revisit")).otherwise(F.lit("response"))),
        F.concat(F.lit("WARC-Record-ID: "), F.col("record_id")),
        F.concat(F.lit("WARC-Date: "), F.col("date")),
        F.concat(F.lit("WARC-Target-URI: "), F.col("uri")),
        F.when(revisit, F.concat(F.lit("WARC-Refers-To: "), F.col("target"))),
        F.when(revisit, F.concat(F.lit("X-Refers-To-Page-Id: "), F.col("first").cast("string"))),
        F.when(revisit, F.lit("WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")),
        F.concat(F.lit("WARC-Payload-Digest: sha256:"), F.col("digest")),
        F.concat(F.lit("WARC-Block-Digest: sha256:"), F.sha2(F.encode(block, "UTF-8"), 256)),
        F.lit("Content-Type: application/http; msgtype=response"),
        F.concat(F.lit("Content-Length: "), F.octet_length(block).cast("string")),
    ]
    folder = fresh(records.sparkSession, "warc")
    for rows, most in _sized(joined, F.col("bytes")):
        _laid(rows.select(F.concat(F.concat_ws("\r\n", *lines), F.lit("\r\n\r\n"), block).alias("value")), folder, "\r\n\r\n", most)
    return folder


def warc_records(raw: bytes):
    """(headers, block) of each record."""
    at = 0
    while at < len(raw):
        end = raw.index(b"\r\n\r\n", at)
        lines = raw[at:end].decode().split("\r\n")
        headers = dict(x.split(": ", 1) for x in lines[1:])
        size = int(headers["Content-Length"])
        block = raw[end + 4 : end + 4 + size]
        if len(block) != size or raw[end + 4 + size : end + 8 + size] != b"\r\n\r\n":
            raise ValueError("a WARC record is cut short")
        at = end + 8 + size
        yield headers, block


def read_warc(spark, folder: str) -> DataFrame:
    """(page_id, payload_bytes, payload_digest, record_type, refers_to, payload): checks block and payload digests."""

    def run(batches):
        for batch in batches:
            for content in batch.column(0):
                out: list[list] = [[] for _ in range(6)]
                held = 0
                for headers, block in warc_records(_opened(content.as_py())):
                    http, _, payload = block.partition(b"\r\n\r\n")
                    fields = dict(x.split(": ", 1) for x in http.decode().split("\r\n")[1:])
                    digest = headers["WARC-Payload-Digest"].removeprefix("sha256:")
                    kind = headers["WARC-Type"]
                    if hashlib.sha256(block).hexdigest() != headers["WARC-Block-Digest"].removeprefix("sha256:"):
                        raise ValueError(f"block digest of {headers['WARC-Record-ID']}")
                    if kind == "response" and hashlib.sha256(payload).hexdigest() != digest:
                        raise ValueError(f"payload digest of {headers['WARC-Record-ID']}")
                    page = fields["X-Page-Id"]
                    refers = headers.get("X-Refers-To-Page-Id")
                    row = (None if page == "-" else int(page), int(fields["Content-Length"]), digest, kind, refers and int(refers), payload.decode() if kind == "response" else None)
                    for o, v in zip(out, row):
                        o.append(v)
                    held += len(block)
                    if held > HELD_BYTES:
                        yield _read_rows(out)
                        out, held = [[] for _ in range(6)], 0
                yield _read_rows(out)

    schema = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, payload string"
    return spark.read.format("binaryFile").load(folder).select("content").mapInArrow(run, schema)


def converted(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """Pages through legacy archives to WARC and back.

    A null page is empty, a null address ``about:blank``; white space in an
    address becomes %20.  Null ids are never pointed to before another id;
    repeated rows of one id are all responses.  No pages give no records.
    """
    spark = pages.sparkSession
    records = written(convert_arc(spark, write_arc(pages, id_col, url_col, html_col)), "records")
    return read_warc(spark, write_warc(records))
