"""Legacy ARC archives to WARC, and WARC back to rows.

``arc_records`` parses ARC files of versions 1 and 2 by their version block: version 1 header lines have 5 fields,
version 2 lines 10, read from the right so that blanks in a URL do no harm; the declared length says where the data
ends. ``convert`` gives each record what WARC wants: an identifier (a name-based UUID of archive and offset, so a rerun
gives the same), an ISO date from the 14 digits, a type from the data (``HTTP/``: a response, whatever the URL), SHA-1 digests of block and payload. Of
equal payloads one stays a response, the others become revisits that refer to it.

The archives are written by Spark's own text writer with the record separator as its line separator (a string column
holds any bytes as they are), so they are committed as any Spark output, to any store, one gzip stream per file. A file
holds a bounded number of records, behind a version block or warcinfo record of its own, since readers take a file whole. Only
digests are grouped (with partial aggregation, so a payload that a third of the records share is no hot task); the
table of revisits is written, and joined by record id, so Spark broadcasts it only if its measured size allows.

Defined results
- null payload: empty; null or empty URL: ``http://unknown.invalid/``; white space in a URL is percent-encoded;
- the response among equal payloads is the one with the greatest key (null least), then date, then identifier;
- payloads of fewer than ``min_bytes`` bytes are never revisits; equal rows are records of their own;
- an empty table gives archives without records and an empty result; extra columns are ignored;
- a header line or length that does not fit raises an error that names the archive and byte.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib
from urllib.parse import quote

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import cut, join_back, shared_path

# Fixed values of the two formats.
ARC_FIELDS = {
    1: "URL IP-address Archive-date Content-type Archive-length",
    2: "URL IP-address Archive-date Content-type Result-code Checksum Location Offset Filename Archive-length",
}
REVISIT = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
RECORD_END = "\r\n\r\n"
NO_URL = "http://unknown.invalid/"
KEY_HEADER = "X-Archive-Key"
EPOCH = "20000101000000"


def digest(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def _gzip_text(df: DataFrame, path: str, end: str, records_per_file: int) -> None:
    (df.select(F.col("value").cast("string")).write.option("lineSep", end).option("compression", "gzip")
     .option("zlib.compress.level", "BEST_SPEED").option("maxRecordsPerFile", records_per_file).text(path))


def _value(rows: list[bytes]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(rows, pa.binary())], names=["value"])


def _in_files(head, rows, records_per_file: int):
    """Batches of rows with ``head(n)`` in front of every ``records_per_file`` of them: with one more row a file, the
    writer starts its files just there."""
    number, room = 0, 0
    for batch in rows:
        out = []
        for row in batch:
            if not room:
                out.append(head(number))
                number, room = number + 1, records_per_file
            out.append(row)
            room -= 1
        yield _value(out)
    if not number:
        yield _value([head(0)])


def write_arc(pages: DataFrame, path: str, url: str = "url", html: str = "html", key: str = "page_id",
              date: str = EPOCH, records_per_file: int = 5_000) -> None:
    """Pages as ARC files of HTTP responses; even partitions are version 1, odd ones version 2."""
    body = pages.select(F.col(f"`{url}`").alias("url"), F.col(f"`{html}`").cast("binary").alias("html"),
                        F.col(f"`{key}`").cast("string").alias("key"))

    def run(batches):
        part = TaskContext.get().partitionId()
        version = 1 + part % 2
        about = f"{version} 0 tessera\n{ARC_FIELDS[version]}\n".encode()

        def head(number: int) -> bytes:
            name = f"part-{part:05d}-{number:05d}.arc"
            extra = "" if version == 1 else f"200 - - 0 {name} "
            return f"filedesc://{name} 0.0.0.0 {date} text/plain {extra}{len(about)}\n".encode() + about

        def records(b: pa.RecordBatch):
            for u, h, k in zip(*(c.to_pylist() for c in b.columns)):
                h = h or b""
                u = re.sub(r"\s+", lambda m: quote(m[0]), u or "") or NO_URL
                keyed = f"{KEY_HEADER}: {k}\r\n" if k is not None else ""
                data = (f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n{keyed}"
                        f"Content-Length: {len(h)}\r\n\r\n").encode() + h
                check = f"200 {digest(data)} - 0 - " if version == 2 else ""
                yield f"{u} 0.0.0.0 {date} text/html {check}{len(data)}\n".encode() + data

        yield from _in_files(head, map(records, batches), records_per_file)

    _gzip_text(body.mapInArrow(run, "value binary"), path, "\n", records_per_file + 1)


def parse_arc(data: bytes, where: str = ""):
    """``(archive, offset, url, ip, date, mime, data)`` of each record; the version block comes first."""
    at, version, archive = 0, None, where
    while at < len(data):
        if data[at:at + 1] == b"\n":
            at += 1
            continue
        stop = data.find(b"\n", at)
        line = data[at:stop].decode("utf-8", "surrogateescape") if stop >= 0 else ""
        if version is None:
            if not line.startswith("filedesc://"):
                raise ValueError(f"{where}: no version block at byte {at}")
            version = data[stop + 1:stop + 2].decode("ascii", "replace")
            if version not in ("1", "2"):
                raise ValueError(f"{where}: unknown ARC version {version!r}")
            version = int(version)
        fields = line.rsplit(" ", 4 if version == 1 else 9)
        if len(fields) != (5 if version == 1 else 10) or not fields[-1].isdigit():
            raise ValueError(f"{where}: bad version {version} header at byte {at}: {line[:200]!r}")
        size = int(fields[-1])
        body = data[stop + 1:stop + 1 + size]
        if len(body) < size:
            raise ValueError(f"{where}: record at byte {at} ends early")
        if _record_type(fields[0], body) == "warcinfo":
            archive = fields[0].removeprefix("filedesc://")
        yield archive, at, fields[0], fields[1], fields[2], fields[3], body
        at = stop + 1 + size


def iso_date(digits: str) -> str:
    d = (digits if digits.isdigit() else EPOCH).ljust(14, "0")[:14]
    month, day = max("01", d[4:6]), max("01", d[6:8])
    return f"{d[:4]}-{month}-{day}T{d[8:10]}:{d[10:12]}:{d[12:14]}Z"


def _split_http(kind: str, data: bytes) -> tuple[bytes, bytes]:
    if kind != "response":
        return b"", data
    head, gap, payload = data.partition(b"\r\n\r\n")
    return (head + gap, payload) if gap else (data, b"")


def _record_type(url: str, data: bytes) -> str:
    # by the archived data: a response may have been fetched from a URL of any scheme, or of none
    if data.startswith(b"HTTP/"):
        return "response"
    return "warcinfo" if url.startswith("filedesc://") else "resource"


def _key(head: bytes) -> int | None:
    m = re.search(rb"\r\n" + KEY_HEADER.encode() + rb": (-?\d+)\r\n", head)
    return int(m[1]) if m else None


_RECORD = ("record_id string, uri string, ip string, date string, mime string, type string, key bigint, "
           "payload_digest string, payload_bytes bigint")


def arc_records(spark: SparkSession, path: str, with_data: bool = True) -> DataFrame:
    """The records of the ARC files below a path, with their WARC identity; ``data`` only where asked for."""
    def run(batches):
        for b in batches:
            for name, content in zip(b.column(0).to_pylist(), b.column(1)):
                raw = content.as_py()
                raw = zlib.decompress(raw, 47) if raw[:2] == b"\x1f\x8b" else raw
                rows = []
                for archive, at, url, ip, date, mime, data in parse_arc(raw, name):
                    kind = _record_type(url, data)
                    if kind == "warcinfo":
                        continue
                    head, payload = _split_http(kind, data)
                    row = (f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{archive}#{at}')}>", url, ip, iso_date(date), mime,
                           kind, _key(head), digest(payload), len(payload))
                    rows.append((*row, data) if with_data else row)
                if rows:
                    types = [pa.string()] * 6 + [pa.int64(), pa.string(), pa.int64()] + [pa.binary()] * with_data
                    names = [x.split()[0] for x in _RECORD.split(", ")] + ["data"] * with_data
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names=names)

    files = spark.read.format("binaryFile").load(path).select("path", "content")
    return files.mapInArrow(run, _RECORD + ", data binary" * with_data)


def convert(spark: SparkSession, arc_path: str, warc_path: str, min_bytes: int = 0, records_per_file: int = 5_000) -> None:
    """Write the records of the ARC files below ``arc_path`` as WARC files below ``warc_path``."""
    slim = arc_records(spark, arc_path, with_data=False).where(F.col("payload_bytes") >= min_bytes)
    order = F.struct(F.col("key"), "date", "record_id", "uri")
    best = cut(slim.groupBy("payload_digest").agg(F.max(order).alias("best"), F.count("*").alias("n")).where("n > 1"))
    revisits = (join_back(slim.select("payload_digest", "record_id"), best, "payload_digest", "n")
                .where("record_id <> best.record_id")
                .select("record_id", F.col("best.record_id").alias("refers_to"), F.col("best.uri").alias("refers_uri"),
                        F.col("best.date").alias("refers_date")))
    table = shared_path(spark, "warc-revisits")
    revisits.write.parquet(table)
    records = arc_records(spark, arc_path).join(spark.read.parquet(table), "record_id", "left")
    columns = ["record_id", "uri", "ip", "date", "mime", "type", "payload_digest", "payload_bytes", "refers_to", "refers_uri",
               "refers_date", "data"]

    def run(batches):
        about = "software: tessera\r\nformat: WARC File Format 1.1\r\n"
        part = TaskContext.get().partitionId()

        def head(number: int) -> bytes:
            own = uuid.uuid5(uuid.NAMESPACE_URL, f"info#{part}#{number}")
            return (f"WARC/1.1\r\nWARC-Type: warcinfo\r\nWARC-Record-ID: <urn:uuid:{own}>\r\n"
                    f"WARC-Date: {iso_date(EPOCH)}\r\nContent-Type: application/warc-fields\r\n"
                    f"Content-Length: {len(about)}\r\n\r\n{about}").encode()

        def lines(b: pa.RecordBatch):
            for rid, uri, ip, date, mime, kind, pay, n, refers, r_uri, r_date, data in zip(*(c.to_pylist() for c in b.columns)):
                block, more = data, ""
                if refers is not None:
                    block = _split_http(kind, data)[0]
                    more = (f"WARC-Profile: {REVISIT}\r\nWARC-Refers-To: {refers}\r\nWARC-Refers-To-Target-URI: {r_uri}\r\n"
                            f"WARC-Refers-To-Date: {r_date}\r\nWARC-Truncated: length\r\n")
                content = "application/http; msgtype=response" if kind == "response" else mime
                yield (
                    f"WARC/1.1\r\nWARC-Type: {kind if refers is None else 'revisit'}\r\nWARC-Record-ID: {rid}\r\nWARC-Date: {date}\r\n"
                    f"WARC-Target-URI: {uri}\r\nWARC-IP-Address: {ip}\r\n{more}WARC-Payload-Digest: sha1:{pay}\r\n"
                    f"WARC-Block-Digest: sha1:{digest(block)}\r\nX-Payload-Length: {n}\r\nContent-Type: {content}\r\n"
                    f"Content-Length: {len(block)}\r\n\r\n").encode("utf-8", "surrogateescape") + block

        yield from _in_files(head, map(lines, batches), records_per_file)

    _gzip_text(records.select(*columns).mapInArrow(run, "value binary"), warc_path, RECORD_END, records_per_file + 1)


def parse_warc(data: bytes, where: str = ""):
    """``(headers, block)`` of each record; names in lower case."""
    at = 0
    while at < len(data):
        stop = data.find(b"\r\n\r\n", at)
        lines = data[at:stop].decode("utf-8", "surrogateescape").split("\r\n")
        if stop < 0 or not lines[0].startswith("WARC/"):
            raise ValueError(f"{where}: no WARC record at byte {at}")
        headers = {k.lower(): v.strip() for k, _, v in (x.partition(":") for x in lines[1:])}
        size = int(headers["content-length"])
        block = data[stop + 4:stop + 4 + size]
        end = stop + 4 + size
        if len(block) < size or data[end:end + 4] != b"\r\n\r\n":
            raise ValueError(f"{where}: record at byte {at} ends early")
        yield headers, block
        at = end + 4


def read_warc(spark: SparkSession, path: str, with_payload: bool = True) -> DataFrame:
    """The records of WARC files. Digests of responses are computed from the payload read, and must agree with the
    header; a revisit gives the digest and length of the payload that it stands for."""
    def run(batches):
        for b in batches:
            for name, content in zip(b.column(0).to_pylist(), b.column(1)):
                raw = content.as_py()
                raw = zlib.decompress(raw, 47) if raw[:2] == b"\x1f\x8b" else raw
                rows = []
                for h, block in parse_warc(raw, name):
                    kind = h["warc-type"]
                    if kind == "warcinfo":
                        continue
                    http = h["content-type"].startswith("application/http")
                    head, payload = _split_http("response" if http else "resource", block)
                    said = h["warc-payload-digest"].removeprefix("sha1:")
                    n = int(h["x-payload-length"])
                    if kind != "revisit" and (digest(payload) != said or len(payload) != n):
                        raise ValueError(f"{name}: {h['warc-record-id']}: payload and digest differ")
                    row = (h["warc-record-id"], h["warc-target-uri"], h["warc-date"], kind, _key(head), said, n, h.get("warc-refers-to"))
                    rows.append((*row, payload) if with_payload else row)
                if rows:
                    types = [pa.string()] * 4 + [pa.int64(), pa.string(), pa.int64(), pa.string()] + [pa.binary()] * with_payload
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)],
                                                     names=names + ["payload"] * with_payload)

    names = ["record_id", "uri", "date", "type", "key", "payload_digest", "payload_bytes", "refers_to"]
    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path).select("path", "content")
    return files.mapInArrow(run, "record_id string, uri string, date string, type string, key bigint, payload_digest string, "
                                 "payload_bytes bigint, refers_to string" + ", payload binary" * with_payload)
