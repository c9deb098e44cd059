"""Operator 4: WARC archives, written by Spark and read back by a salvage reader.

Writing: one record a page. Pages with equal payloads of at least
``REVISIT_BYTES`` are grouped by digest; the one with the largest id is written
whole (response) and the others refer to it (revisit, which keeps the HTTP
header but no payload). Records are columns put together in the JVM and written
by Spark's text writer, whose commit leaves no half-written files when
executors are lost; the blank lines that end a record are its line separator.
Files hold about ``FILE_BYTES`` each.

Reading: a record is good when its version line, its header, its length, the
blank lines after it and its block digest all hold. After a failed check the
reader looks for the next version line (or, in compressed archives, the next
gzip member) from which a record is good again, goes on there, and returns the
bytes in between as a quarantined gap with the reason. Good records are never
lost to a bad neighbour. A gzip member may hold any number of records: its
inflated bytes are read in the same way, and records and gaps in it have the
member's place in the file and their own offset inside. Of a member whose stream
is damaged the records before the damage are returned (they end where they
start, as the gap that follows has the member's bytes); what lies behind the
damage in that member cannot be inflated.

Null html: an empty payload. Null page_id or url: written without that header
and read back as null. Repeated rows are records of their own; equal payloads
of one page_id twice refer to it by that id, the row itself being response.
No pages: no archive, no records.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from edgeworks.loop import Workspace, shared_dir

REVISIT_BYTES = 1000
FILE_BYTES = 16 << 20
BROADCAST_GROUPS = 200_000
VERSION = b"WARC/1.1"
END = "\r\n\r\n"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_VERSION_LINE = re.compile(rb"WARC/(?:0\.1[78]|1\.[01])\r\n")
GZIP = b"\x1f\x8b\x08"


# Writing


def with_revisits(pages: DataFrame, least: int = REVISIT_BYTES, broadcast_groups: int = BROADCAST_GROUPS) -> DataFrame:
    """``(page_id, url, payload, digest, refers_to)``; refers_to is null for responses."""
    rows = pages.select("page_id", "url", F.coalesce("html", F.lit("")).alias("payload")).withColumn("digest", F.sha1("payload"))
    long = F.octet_length("payload") >= least
    # One row for each payload seen twice. While these are few, which is counted, they are broadcast
    # and payloads are not shuffled. Else the join is from many pages to one row, which adaptive
    # execution splits where one payload is very common.
    groups = rows.filter(long).groupBy("digest").agg(F.max("page_id").alias("last"), F.count(F.lit(1)).alias("n")).filter("n > 1").drop("n")
    groups, seen = Workspace(pages.sparkSession).keep(groups, "payloads")
    key = groups.withColumnRenamed("digest", "of")
    key = F.broadcast(key) if seen["rows"] <= broadcast_groups else key
    joined = rows.join(key, (rows["digest"] == key["of"]) & long, "left").drop("of")
    other = F.col("last").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("last"))
    return joined.select("page_id", "url", "payload", "digest", F.when(other, F.col("last")).alias("refers_to"))


def _header(name: str, value: Column) -> Column:
    """A header line, or nothing for a null. Line ends cannot be part of a value."""
    clean = F.regexp_replace(value, r"[\x00-\x20\x7f]", "%20")
    return F.when(value.isNull(), F.lit("")).otherwise(F.concat(F.lit(f"{name}: "), clean, F.lit("\r\n")))


def records(rows: DataFrame) -> DataFrame:
    """One column ``value``: the records as text, without their end."""
    revisit = F.col("refers_to").isNotNull()
    http = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "), F.octet_length("payload").cast("string"), F.lit(END))
    block = F.when(revisit, http).otherwise(F.concat(http, "payload"))
    named = lambda c: F.concat(F.lit("<urn:page:"), c.cast("string"), F.lit(">"))
    said = rows.select("*", block.alias("block"), revisit.alias("revisit"))
    head = F.concat(
        F.lit(f"{VERSION.decode()}\r\nWARC-Type: "), F.when(F.col("revisit"), "revisit").otherwise("response"), F.lit("\r\n"),
        _header("WARC-Record-ID", named(F.col("page_id"))), _header("WARC-Target-URI", F.col("url")),
        F.lit("WARC-Date: 1970-01-01T00:00:00Z\r\nContent-Type: application/http; msgtype=response\r\n"),
        F.lit("WARC-Payload-Digest: sha1:"), F.col("digest"), F.lit("\r\nWARC-Block-Digest: sha1:"), F.sha1("block"), F.lit("\r\n"),
        F.when(F.col("revisit"), F.lit(f"WARC-Profile: {PROFILE}\r\n")).otherwise(""),
        _header("WARC-Refers-To", named(F.col("refers_to"))),
        F.lit("Content-Length: "), F.octet_length("block").cast("string"), F.lit(END))
    return said.select(F.concat(head, "block").alias("value"))


def write_archives(pages: DataFrame, path: str, least: int = REVISIT_BYTES, file_bytes: int = FILE_BYTES) -> None:
    """Write plain WARC files of about ``file_bytes`` each below ``path``."""
    n, total = pages.agg(F.count(F.lit(1)), F.sum(F.octet_length("html"))).first()
    each = max(1, int(file_bytes * n // max(1, (total or 0) + 500 * n))) if n else 1
    records(with_revisits(pages, least)).write.option("lineSep", END).option("maxRecordsPerFile", each).text(path)


# Reading


@dataclass
class Record:
    start: int
    end: int
    headers: dict[str, str]
    block: bytes
    #: In a gzip member, where in its inflated bytes; start and end are then the member's.
    inside: int | None = None


@dataclass
class Gap:
    start: int
    end: int
    reason: str
    inside: int | None = None


def _digest_holds(said: str | None, data: bytes) -> bool:
    """Whether a labelled SHA-1 digest, in hexadecimal or base 32, is that of ``data``."""
    if not said or not said.lower().startswith("sha1:"):
        return True
    found, value = hashlib.sha1(data), said[5:].strip()
    return value.lower() == found.hexdigest() or value.upper() == base64.b32encode(found.digest()).decode()


def parse_record(data: bytes, at: int = 0) -> Record | str:
    """The record that starts at ``at``, or why there is no good one."""
    version = _VERSION_LINE.match(data, at)
    if not version:
        return "no version line"
    close = data.find(b"\r\n\r\n", version.end() - 2)
    if close < 0:
        return "header without end"
    headers: dict[str, str] = {}
    for line in data[version.end():close].split(b"\r\n"):
        name, colon, value = line.partition(b":")
        if line and not colon or b"\r" in line or b"\n" in line:
            return "header line without a name, or with a stray line end"
        headers[name.decode("utf-8", "replace").strip().lower()] = value.decode("utf-8", "replace").strip()
    if not headers.get("content-length", "").isdigit():
        return "no length"
    begin = close + 4
    end = begin + int(headers["content-length"])
    if data[end:end + 4] != b"\r\n\r\n":
        return "length does not lead to the end of the record"
    block = data[begin:end]
    if not _digest_holds(headers.get("warc-block-digest"), block):
        return "block digest differs"
    return Record(at, end + 4, headers, block)


def _inflate(data: bytes, at: int, step: int = 1 << 16) -> tuple[bytes, int, str]:
    """One gzip member: its content, where it ends, and what is wrong with it, if anything.

    Fed in steps, so that no rest is copied. Of a damaged one the content is what comes before the damage.
    """
    stream, parts, fed, view, why = zlib.decompressobj(31), [], at, memoryview(data), ""
    try:
        while not stream.eof and fed < len(data):
            parts.append(stream.decompress(view[fed:fed + step]))
            fed += step
    except zlib.error as e:
        why = f"damaged member: {e}"
        # The step that failed has returned nothing: once more, and byte by byte up to the damage.
        stream = zlib.decompressobj(31)
        parts = [stream.decompress(view[at:fed])]
        try:
            for i in range(fed, min(fed + step, len(data))):
                parts.append(stream.decompress(view[i:i + 1]))
        except zlib.error:
            pass
    if not stream.eof and not why:
        why = "member without end"
    return b"".join(parts), min(fed, len(data)) - len(stream.unused_data), why


def _member(data: bytes, at: int) -> tuple[list[Record | Gap], int, str]:
    """What the gzip member that starts at ``at`` holds, where it ends, and why it is bad, if it is."""
    content, end, why = _inflate(data, at)
    found = list(salvage(content, members=False))
    good = [x for x in found if isinstance(x, Record)]
    if why:
        return [Record(at, at, x.headers, x.block, x.start) for x in good], at, why
    if not good:
        return [], at, found[0].reason if found else "empty member"
    return [Record(at, end, x.headers, x.block, x.start) if isinstance(x, Record) else Gap(at, end, x.reason, x.start) for x in found], end, ""


def salvage(data: bytes, members: bool = True) -> Iterator[Record | Gap]:
    """All good records of an archive, and the gaps between them, in order.

    Archives of gzip members and plain ones, and files in which both occur;
    without ``members`` only plain ones.
    """
    at, bad, why, none = 0, None, "", len(data)
    version = member = -1
    while at < len(data):
        if members and data[at:at + 3] == GZIP:
            found, end, wrong = _member(data, at)
        else:
            record = parse_record(data, at)
            found, end, wrong = ([], at, record) if isinstance(record, str) else ([record], record.end, "")
        if found and bad is not None:
            yield Gap(bad, at, why)
            bad = None
        yield from found
        if not wrong:
            at = end
            continue
        if bad is None:
            bad, why = at, wrong
        if version <= at:
            line = _VERSION_LINE.search(data, at + 1)
            version = line.start() if line else none
        if member <= at:
            member = data.find(GZIP, at + 1) if members else -1
            member = none if member < 0 else member
        at = min(version, member)
    if bad is not None:
        yield Gap(bad, len(data), why)


SCHEMA = "path string, start long, end long, inside long, gap string, record_type string, record_id string, uri string, refers_to string, payload_digest string, payload_bytes long, payload binary"


def _payload(record: Record) -> tuple[int | None, bytes]:
    """Length of the full payload by the HTTP header, and what of it the record holds."""
    head, _, body = record.block.partition(b"\r\n\r\n")
    said = re.search(rb"(?im)^content-length:\s*(\d+)\s*$", head)
    return (int(said[1]) if said else len(body)), body


def _hex(digest: str | None) -> str | None:
    value = (digest or "").partition(":")[2].strip()
    if len(value) == 32:
        return base64.b32decode(value.upper()).hex()
    return value.lower() or None


def read_archives(spark: SparkSession, path: str, payloads: bool = True) -> DataFrame:
    """Every record and every gap (``gap`` says why) of the archives below ``path``.

    A file is one task's work, so memory follows the size of a file, and of its largest member when inflated.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [x.split()[0] for x in SCHEMA.split(", ")]
        for batch in batches:
            for name, content in zip(batch["path"], batch["content"], strict=True):
                where, rows = name.as_py(), []
                for x in salvage(content.as_buffer().to_pybytes()):
                    if isinstance(x, Gap):
                        rows.append((where, x.start, x.end, x.inside, x.reason, *[None] * 7))
                        continue
                    h, (size, body) = x.headers, _payload(x)
                    rows.append((where, x.start, x.end, x.inside, None, h.get("warc-type"), h.get("warc-record-id"), h.get("warc-target-uri"), h.get("warc-refers-to"), _hex(h.get("warc-payload-digest")), size, body if payloads else None))
                columns = zip(*rows, strict=True) if rows else [()] * len(names)
                kinds = [pa.string(), pa.int64(), pa.int64(), pa.int64(), *[pa.string()] * 6, pa.int64(), pa.binary()]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names)

    files = spark.read.format("binaryFile").load(path).select("path", "content")
    return files.mapInArrow(run, SCHEMA)


def round_trip(pages: DataFrame, path: str | None = None) -> DataFrame:
    """Write all pages, read the archives back, and return what the records say."""
    spark = pages.sparkSession
    path = path or f"{shared_dir(spark)}/warc-{uuid.uuid4().hex}"
    write_archives(pages, path)
    page = lambda c: F.nullif(F.regexp_extract(c, r"<urn:page:(-?\d+)>", 1), F.lit("")).cast("long")
    back = read_archives(spark, path, payloads=False).filter(F.col("gap").isNull())
    return back.select(
        page("record_id").alias("page_id"), "payload_bytes", "payload_digest", "record_type", page("refers_to").alias("refers_to"))


ORACLE = """
WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
g AS (SELECT html, max(page_id) AS last FROM p WHERE strlen(html) >= 1000 GROUP BY html HAVING count(*) > 1)
SELECT page_id, strlen(p.html)::BIGINT AS payload_bytes, sha1(p.html) AS payload_digest,
  CASE WHEN last IS NULL OR last = page_id THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN last <> page_id THEN last END AS refers_to
FROM p LEFT JOIN g ON p.html = g.html
"""
