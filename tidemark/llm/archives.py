"""Legacy ARC archives to WARC, and both written and read with Spark.

An ARC file begins with a version block whose first body line names the version; every record is a header line of
that version's fields, the last of them the declared length, and that many bytes. The converter parses the lines by
version, cuts records by declared length and synthesises the WARC headers: identifier, date, type and digests.

Files are written by Spark's text writer, gzipped whole: a record ends with its format's own separator, so the
bytes are those of the formats, also of payloads that are no text. Readers stream one file at a time. A file is as large as one
task's share of the input, which spark.sql.files.maxPartitionBytes bounds.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import io
import re
import uuid
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.session import materialize, scratch_path

#: Fields of a record's header line by version.
ARC_FIELDS = {
    "1": ("URL", "IP-address", "Archive-date", "Content-type", "Archive-length"),
    "2": (
        "URL", "IP-address", "Archive-date", "Content-type", "Result-code", "Checksum", "Location", "Offset", "Filename", "Archive-length",
    ),
}
CAPTURED = "20240101000000"
#: Equal payloads of at least so many bytes are stored once.
LEAST_REVISIT_BYTES = 0
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_NAMESPACE = uuid.UUID("6ba7b811-9dad-11d1-80b4-00c04fd430c8")
_RECORD = "page_id long, url string, ip string, date string, mime string, digest string, bytes long, block binary"


def digest(payload: bytes) -> str:
    """Base32 of the SHA-1."""
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record_id(*parts) -> str:
    """The same record always gets the same identifier."""
    return uuid.uuid5(_NAMESPACE, "\x1f".join(map(str, parts))).urn


def arc_url(url: str | None) -> str:
    """Header lines are split at blanks, so blanks and control characters are escaped."""
    return re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url or "unknown:")


def arc_header(version: str, url: str, date: str, mime: str, length: int) -> bytes:
    if version == "1":
        return f"{url} 0.0.0.0 {date} {mime} {length}\n".encode()
    return f"{url} 0.0.0.0 {date} {mime} 200 - - 0 - {length}\n".encode()


def arc_version_block(version: str) -> bytes:
    body = f"{version} 0 tidemark\n{' '.join(ARC_FIELDS[version])}\n".encode()
    return arc_header(version, "filedesc://tidemark.arc", CAPTURED, "text/plain", len(body)) + body


def _http_block(page_id: int | None, payload: bytes) -> bytes:
    name = "" if page_id is None else f"X-Page-Id: {page_id}\r\n"
    return f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n{name}Content-Length: {len(payload)}\r\n\r\n".encode() + payload


def _arc_batches(version: Callable[[int], str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = version(TaskContext.get().partitionId())
        yield pa.RecordBatch.from_arrays([pa.array([arc_version_block(own)], pa.binary())], names=["record"])
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                ids, urls, pages = (batch.column(i).slice(at, 256).to_pylist() for i in range(3))
                records = []
                for page_id, url, page in zip(ids, urls, pages, strict=True):
                    block = _http_block(page_id, (page or "").encode())
                    records.append(arc_header(own, arc_url(url), CAPTURED, "text/html", len(block)) + block)
                yield pa.RecordBatch.from_arrays([pa.array(records, pa.binary())], names=["record"])

    return run


def _write(records: DataFrame, path: str, separator: str) -> None:
    records.select(F.col("record").cast("string")).write.option("lineSep", separator).option("compression", "gzip").text(path)


def write_arc(pages: DataFrame, path: str) -> None:
    """``pages`` (page_id, url, html) as ARC files, version 1 and 2 in turn; NULL html is an empty payload."""
    rows = pages.select(F.col("page_id").cast("long"), F.col("url").cast("string"), F.col("html").cast("string"))
    _write(rows.mapInArrow(_arc_batches(lambda part: "12"[part % 2]), "record binary"), path, "\n")


@dataclass
class ArcRecord:
    url: str
    ip: str
    date: str
    mime: str
    block: bytes


def arc_records(stream) -> Iterator[ArcRecord]:
    """Records of an ARC stream after its version block. Raises on a line or length that the version does not allow."""
    version = None
    while line := stream.readline():
        if line in (b"\n", b"\r\n"):
            continue
        parts = line.decode("utf-8", "replace").rstrip("\r\n").split(" ")
        fields = ARC_FIELDS[version] if version else ARC_FIELDS["2" if len(parts) == len(ARC_FIELDS["2"]) else "1"]
        if len(parts) != len(fields):
            raise ValueError(f"ARC header line with {len(parts)} fields instead of {len(fields)}: {line[:200]!r}")
        named = dict(zip(fields, parts, strict=True))
        length = int(named["Archive-length"])
        block = stream.read(length)
        if len(block) != length:
            raise ValueError(f"ARC record of {named['URL']} ends after {len(block)} of {length} bytes")
        if version is None:
            version = block.split(b" ", 1)[0].decode()
            if version not in ARC_FIELDS:
                raise ValueError(f"ARC version {version!r}")
            continue
        yield ArcRecord(named["URL"], named["IP-address"], named["Archive-date"], named["Content-type"], block)


def split_http(block: bytes) -> tuple[dict[str, str], bytes]:
    """Headers in small letters, and the payload; a block without an HTTP head is all payload."""
    if not block.startswith(b"HTTP/"):
        return {}, block
    head, _, payload = block.partition(b"\r\n\r\n")
    lines = [x.partition(":") for x in head.decode("utf-8", "replace").split("\r\n")[1:]]
    return {k.strip().lower(): v.strip() for k, _, v in lines}, payload


def _opened(content: bytes):
    zipped = content[:2] == b"\x1f\x8b"
    return io.BufferedReader(gzip.GzipFile(fileobj=io.BytesIO(content)), 1 << 20) if zipped else io.BufferedReader(io.BytesIO(content))


def _in_batches(rows: Iterator[tuple], schema: pa.Schema, limit: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    held, size = [], 0
    for row in rows:
        held.append(row)
        size += 200 + len(row[-1] or b"") if isinstance(row[-1], bytes) else 200
        if size >= limit:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*held, strict=True), schema.types, strict=True)], schema=schema)
            held, size = [], 0
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*held, strict=True), schema.types, strict=True)], schema=schema)


def _arc_reader(with_block: bool):
    schema = pa.schema([("page_id", pa.int64()), *((n, pa.string()) for n in ("url", "ip", "date", "mime", "digest")), ("bytes", pa.int64()), ("block", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in batch.column(0):

                def rows(content=content):
                    for r in arc_records(_opened(content.as_py())):
                        headers, payload = split_http(r.block)
                        number = headers.get("x-page-id")
                        yield int(number) if number else None, r.url, r.ip, r.date, r.mime, digest(payload), len(payload), r.block if with_block else None

                yield from _in_batches(rows(), schema)

    return run


def _files(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path).select("content")


def read_arc(spark: SparkSession, path: str, with_block: bool = True) -> DataFrame:
    """Records of the ARC files below ``path``: page_id (if the response names one), header fields, payload digest, bytes, block."""
    return _files(spark, path).mapInArrow(_arc_reader(with_block), _RECORD)


def warc_date(date: str) -> str:
    """14 digits, or 12 as older tools wrote them, as an ISO date."""
    d = date.ljust(14, "0")
    return f"{d[:4]}-{d[4:6]}-{d[6:8]}T{d[8:10]}:{d[10:12]}:{d[12:14]}Z"


def _warc(headers: list[tuple[str, object]], block: bytes) -> bytes:
    lines = [f"{k}: {v}" for k, v in headers if v is not None]
    return ("WARC/1.1\r\n" + "\r\n".join(lines) + f"\r\nContent-Length: {len(block)}\r\n\r\n").encode() + block


def warc_record(page_id, url, ip, date, mime, payload_digest, size, block, refers_to) -> bytes:
    """The WARC form of one ARC record: a response, a revisit without payload, or a resource if there is no HTTP head."""
    http = block.startswith(b"HTTP/")
    shared = [
        ("WARC-Record-ID", f"<{record_id(url, date, payload_digest, page_id)}>"), ("WARC-Date", warc_date(date)),
        ("WARC-Target-URI", url), ("WARC-IP-Address", ip), ("WARC-Payload-Digest", f"sha1:{payload_digest}"),
        ("X-Page-Id", page_id), ("X-Payload-Length", size),
    ]
    if refers_to is None:
        kind, body = ("response" if http else "resource"), block
        extra = []
    else:
        kind, body = "revisit", (block.partition(b"\r\n\r\n")[0] + b"\r\n\r\n" if http else b"")
        extra = [("WARC-Profile", REVISIT_PROFILE), ("X-Refers-To-Page-Id", refers_to)]
    mime = "application/http;msgtype=response" if http else mime
    return _warc([("WARC-Type", kind), *shared, *extra, ("WARC-Block-Digest", f"sha1:{digest(body)}"), ("Content-Type", mime)], body)


def _warc_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    about = b"software: tidemark\r\nformat: WARC File Format 1.1\r\n"
    part = TaskContext.get().partitionId()
    first = _warc(
        [("WARC-Type", "warcinfo"), ("WARC-Record-ID", f"<{record_id('warcinfo', part)}>"), ("WARC-Date", warc_date(CAPTURED)), ("Content-Type", "application/warc-fields")], about
    )
    yield pa.RecordBatch.from_arrays([pa.array([first], pa.binary())], names=["record"])
    for batch in batches:
        for at in range(0, batch.num_rows, 256):
            columns = [batch.column(i).slice(at, 256).to_pylist() for i in range(batch.num_columns)]
            yield pa.RecordBatch.from_arrays([pa.array([warc_record(*r) for r in zip(*columns, strict=True)], pa.binary())], names=["record"])


def convert(spark: SparkSession, arc_path: str, warc_path: str, least_bytes: int = LEAST_REVISIT_BYTES) -> None:
    """The ARC files below ``arc_path`` as WARC files below ``warc_path``.

    Of records with equal payloads of ``least_bytes`` or more, that with the largest page_id is a response and
    others revisit it. Groups are found on digests alone; payloads are joined with the groups of two or more only.
    """
    keys = read_arc(spark, arc_path, with_block=False).where(F.col("bytes") >= least_bytes)
    groups = keys.groupBy("digest", "bytes").agg(F.max("page_id").alias("last"), F.count("*").alias("n")).where("n > 1").drop("n")
    groups = materialize(groups, "equal-payloads")
    records = read_arc(spark, arc_path).join(groups, ["digest", "bytes"], "left")
    refers = F.when(F.coalesce(F.col("page_id") < F.col("last"), F.col("last").isNotNull()), F.col("last"))
    rows = records.select("page_id", "url", "ip", "date", "mime", "digest", "bytes", "block", refers.alias("refers_to"))
    _write(rows.mapInArrow(_warc_batches, "record binary"), warc_path, "\r\n\r\n")


def warc_records(stream) -> Iterator[tuple[dict[str, str], bytes]]:
    """Headers in small letters, and block, of every record of a WARC stream."""
    while line := stream.readline():
        if not line.strip():
            continue
        if not line.startswith(b"WARC/"):
            raise ValueError(f"no WARC record begins with {line[:200]!r}")
        headers = {}
        while (line := stream.readline()) not in (b"\r\n", b"\n", b""):
            k, _, v = line.decode("utf-8", "replace").partition(":")
            headers[k.strip().lower()] = v.strip()
        length = int(headers["content-length"])
        block = stream.read(length)
        if len(block) != length:
            raise ValueError(f"WARC record {headers.get('warc-record-id')} ends after {len(block)} of {length} bytes")
        yield headers, block


def _warc_reader(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Checks each response's digest against the payload it holds."""
    schema = pa.schema([
        ("page_id", pa.int64()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("record_type", pa.string()),
        ("refers_to", pa.int64()), ("record_id", pa.string()), ("url", pa.string()), ("captured", pa.string()),
    ])
    for batch in batches:
        for content in batch.column(0):

            def rows(content=content):
                for h, block in warc_records(_opened(content.as_py())):
                    if h["warc-type"] == "warcinfo":
                        continue
                    found, size = h["warc-payload-digest"].partition(":")[2], int(h["x-payload-length"])
                    if h["warc-type"] != "revisit":
                        payload = split_http(block)[1]
                        if digest(payload) != found or len(payload) != size:
                            raise ValueError(f"payload of {h['warc-record-id']} does not have its digest")
                    number, refers = h.get("x-page-id"), h.get("x-refers-to-page-id")
                    yield (
                        int(number) if number else None, size, found, h["warc-type"], int(refers) if refers else None,
                        h["warc-record-id"], h["warc-target-uri"], h["warc-date"],
                    )

            yield from _in_batches(rows(), schema)


def read_warc(spark: SparkSession, path: str) -> DataFrame:
    """(page_id, payload_bytes, payload_digest, record_type, refers_to, record_id, url, captured) of every record but warcinfo."""
    columns = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, record_id string, url string, captured string"
    return _files(spark, path).mapInArrow(_warc_reader, columns)


def archive_pages(pages: DataFrame, folder: str | None = None) -> DataFrame:
    """``pages`` (page_id, url, html) through ARC files into WARC files, read back; see ``read_warc``.

    Files go to ``folder``/arc and /warc, by default a new one in the shared folder. One row per row of ``pages``:
    rows repeating page_id and html are records of their own, all responses if theirs is the largest page_id. Rows without
    page_id are the smallest of their group. NULL html is an empty payload; other columns are left out.
    """
    spark = pages.sparkSession
    folder = folder or scratch_path(spark, "archives")
    write_arc(pages, f"{folder}/arc")
    convert(spark, f"{folder}/arc", f"{folder}/warc")
    return read_warc(spark, f"{folder}/warc")
