"""WARC archives: a Spark writer and a salvage reader (operator 3).

Writing: each page is one record; of equal payloads of ``MIN_SHARED`` bytes or more the one
with the smallest id is a response and the others are revisits without payload.  Records
are plain strings, so Spark's text sink writes the archives (the two line breaks that end a
record are its line separator); its committer makes retried tasks safe.  Rows per file are
limited by the longest payload, so that no archive passes ``ARCHIVE_BYTES`` (one record
may).  Equal payloads are found on digests with map-side aggregation; only digests that
occur twice are joined back.  They are written and counted, and broadcast when their
exact number proves them small, so payloads are not shuffled; beyond that Spark shuffles
both sides and may split a hot digest.

Reading: every archive is one row of the ``binaryFile`` source, parsed member by member (gzip)
or record by record (plain).  When a check fails (version line, header, length, end of
record, member checksum, payload digest) the reader searches for the next position where
a whole valid member or record starts, goes on there, and logs the bytes between as a
quarantined gap with the reason.  Inside a member the same search runs over the inflated
bytes: valid records beside a bad one stay, and each gap is logged with the member's place
and the inflated bytes in its reason.  Of a member that is cut off or damaged, the
records inflated before the error follow the gap; they have passed the checks of a plain
record.  A member is inflated up to ``INFLATED_MOST`` bytes; one that holds more is treated
like a damaged one there: the records up to that place follow the gap.
A header ends at the end of the data or the next version line at the latest.
Archives must stay under the 2 GB of that source.

Defined results: null html is an empty payload; a null id is written as ``null`` and read
back as null, and never is what a revisit refers to; rows that repeat the smallest id are
all responses; an empty table gives archives without records; line breaks and blanks in a
URL are percent-encoded; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from citymotion.llm.common import ship_package, written
from citymotion.session import broadcast_if_bounded

MIN_SHARED = 100
ARCHIVE_BYTES = 256 << 20
INFLATED_PART = 1 << 14
INFLATED_MOST = 1 << 30
DIGEST_BYTES = 160  # of a broadcast digest with its id
BREAK = "\r\n"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
ID = "urn:page:"


def with_types(pages: DataFrame, min_shared: int = MIN_SHARED) -> DataFrame:
    """(page_id, url, payload, bytes, digest, record_type, refers_to) of each page."""
    payload = F.coalesce(F.col("html").cast("string"), F.lit(""))
    rows = pages.select("page_id", "url", payload.alias("payload")).select("*", F.octet_length("payload").cast("long").alias("bytes"), F.sha2("payload", 256).alias("digest"))
    shared = rows.filter(F.col("bytes") >= min_shared).groupBy("digest").agg(F.min("page_id").alias("first"), F.count("*").alias("n"))
    shared = written(shared.filter("n > 1 AND first IS NOT NULL").select("digest", "first"), "shared")
    shared = broadcast_if_bounded(shared, shared.count(), DIGEST_BYTES)
    again = F.col("first").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first"))
    return rows.join(shared, "digest", "left").select(
        "page_id", "url", "payload", "bytes", "digest", F.when(again, "revisit").otherwise("response").alias("record_type"), F.when(again, F.col("first")).alias("refers_to")
    )


def _name(page_id: Column) -> Column:
    return F.concat(F.lit(f"<{ID}"), F.coalesce(page_id.cast("string"), F.lit("null")), F.lit(">"))


def record(date: str = "1970-01-01T00:00:00Z") -> Column:
    """The record's text, without the two line breaks that end it, from ``with_types`` columns."""
    revisit = F.col("record_type") == "revisit"
    http = F.concat(F.lit(f"HTTP/1.1 200 OK{BREAK}Content-Type: text/html; charset=utf-8{BREAK}Content-Length: "), F.col("bytes").cast("string"), F.lit(BREAK * 2))
    block = F.when(revisit, http).otherwise(F.concat(http, F.col("payload")))
    url = F.coalesce(F.col("url").cast("string"), F.lit(""))
    for sign, code in (("\r", "%0D"), ("\n", "%0A"), (" ", "%20")):
        url = F.replace(url, F.lit(sign), F.lit(code))
    line = lambda name, value: F.concat(F.lit(f"{name}: "), value, F.lit(BREAK))
    refers = F.concat(line("WARC-Refers-To", _name(F.col("refers_to"))), line("WARC-Profile", F.lit(PROFILE)))
    return F.concat(
        F.lit(f"WARC/1.1{BREAK}"), line("WARC-Type", F.col("record_type")), line("WARC-Record-ID", _name(F.col("page_id"))),
        line("WARC-Date", F.lit(date)), line("WARC-Target-URI", url), line("WARC-Payload-Digest", F.concat(F.lit("sha256:"), F.col("digest"))),
        F.when(revisit, refers).otherwise(""), line("Content-Type", F.lit("application/http; msgtype=response")),
        line("Content-Length", F.octet_length(block).cast("string")), F.lit(BREAK), block,
    )


def write_warc(pages: DataFrame, path: str, min_shared: int = MIN_SHARED, archive_bytes: int = ARCHIVE_BYTES) -> None:
    """Write ``pages`` (page_id, url, html) as archives below ``path``."""
    longest = pages.agg(F.max(F.octet_length("html"))).first()[0] or 0
    most = max(1, archive_bytes // (longest + 1024))
    records = with_types(pages, min_shared).select(record().alias("value"))
    records.write.option("lineSep", BREAK * 2).option("maxRecordsPerFile", most).text(path)


# ---------------------------------------------------------------- reading

_END = b"\r\n\r\n"
_VERSION = re.compile(rb"WARC/1\.[01]\r\n")
_HEADER_END = re.compile(rb"\r\n(?:(\r\n)|(?=WARC/1\.[01]\r\n))")
_START = re.compile(rb"\x1f\x8b\x08|WARC/1\.[01]\r\n")


class Damaged(Exception):
    """A check failed."""


def _plain(data: bytes, at: int) -> tuple[dict[str, str], bytes, int]:
    """Headers, block and end of the record at ``at``."""
    m = _VERSION.match(data, at)
    if not m:
        raise Damaged("no version line")
    ended = _HEADER_END.search(data, m.end() - 2)
    if not ended or not ended.group(1):
        raise Damaged("header has no end")
    stop = ended.start()
    headers: dict[str, str] = {}
    for raw in data[m.end() : stop].split(b"\r\n"):
        name, colon, value = raw.partition(b":")
        if raw and not colon:
            raise Damaged("header line without a name")
        headers[name.strip().decode("utf-8", "replace").lower()] = value.strip().decode("utf-8", "replace")
    length = headers.get("content-length", "")
    if not (length.isascii() and length.isdigit()):
        raise Damaged("no content length")
    if "warc-type" not in headers or "warc-record-id" not in headers:
        raise Damaged("a mandatory header is missing")
    start, end = stop + 4, stop + 4 + int(length)
    if data[end : end + 4] != _END:
        raise Damaged("record does not end after its content length")
    block = data[start:end]
    kind, _, digest = headers.get("warc-payload-digest", "").partition(":")
    if kind == "sha256" and headers["warc-type"] != "revisit" and hashlib.sha256(payload_of(headers, block)).hexdigest() != digest.lower():
        raise Damaged("payload digest differs")
    return headers, block, end + 4


def payload_of(headers: dict[str, str], block: bytes) -> bytes:
    """The block without the HTTP header, if it has one."""
    if headers.get("content-type", "").startswith("application/http"):
        return block.partition(_END)[2]
    return block


def _inflated(data: bytes, at: int) -> tuple[bytes, int, str | None]:
    """What the gzip member at ``at`` holds, its end and what is wrong with it; if it is
    damaged or too large, all that was inflated before and the place of the error."""
    d = zlib.decompressobj(31)
    try:
        inner = d.decompress(memoryview(data)[at:], INFLATED_MOST)
        if d.unconsumed_tail:
            return inner, len(data) - len(d.unconsumed_tail), f"gzip member holds over {INFLATED_MOST} bytes"
        return inner, len(data) - len(d.unused_data), None if d.eof else "gzip member has no end"
    except zlib.error:
        pass
    d, parts, size, held = zlib.decompressobj(31), [], INFLATED_PART, 0
    while True:
        before = d.copy()
        try:
            parts.append(d.decompress(data[at : at + size], INFLATED_MOST))
            at, held = at + size, held + len(parts[-1])
            if held >= INFLATED_MOST:
                return b"".join(parts), at, "gzip member is damaged"
        except zlib.error:  # again byte by byte, up to the error
            if size == 1:
                return b"".join(parts), at, "gzip member is damaged"
            d, size = before, 1


def salvage(data: bytes, packed: bool = True) -> Iterator[tuple[int, int, dict[str, str] | None, bytes | None, str | None]]:
    """(offset, length, headers, block, None) of each valid record, in order, and
    (offset, length, None, None, reason) of each gap that was quarantined.  Gzip members
    are looked for if ``packed``; records that a damaged one gave follow its gap."""
    start = _START if packed else _VERSION
    at, bad, reason = 0, None, None
    rescued, known, inflated_to = [], set(), 0
    while at < len(data):
        try:
            if packed and data.startswith(b"\x1f\x8b", at):
                inner, end, wrong = _inflated(data, at)
                rows = [(at, end - at, h, b, why and f"{why} (inflated bytes {o} to {o + n} of a gzip member)") for o, n, h, b, why in salvage(inner, False)]
                if wrong:
                    rescued += [r for r in rows if r[2] is not None]
                    known.update((tuple(r[2].items()), r[3]) for r in rescued)
                    inflated_to = max(inflated_to, end)
                    raise Damaged(wrong)
            else:
                headers, block, end = _plain(data, at)
                rows = [(at, end - at, headers, block, None)]
                if at < inflated_to and (tuple(headers.items()), block) in known:
                    at = end  # a stored block of the member: this record has been inflated
                    continue
        except Damaged as e:
            if bad is None:
                bad, reason = at, str(e)
            m = start.search(data, at + 1)
            at = m.start() if m else len(data)
            continue
        if bad is not None:
            yield bad, at - bad, None, None, reason
            yield from rescued
            bad, rescued, known, inflated_to = None, [], set(), 0
        yield from rows
        at = end
    if bad is not None:
        yield bad, len(data) - bad, None, None, reason
        yield from rescued


READ = "path string, offset long, length long, headers map<string,string>, block binary, payload binary, quarantined string"


def read_warc(spark: SparkSession, path: str) -> DataFrame:
    """``READ`` rows: records (``quarantined`` null; header names in lower case) and gaps
    (``quarantined`` is the reason; the bytes are [offset, offset + length) of the file)."""
    ship_package(spark)
    files = spark.read.format("binaryFile").load(path).select("path", "content")
    schema = pa.schema([("path", pa.string()), ("offset", pa.int64()), ("length", pa.int64()), ("headers", pa.map_(pa.string(), pa.string())), ("block", pa.binary()), ("payload", pa.binary()), ("quarantined", pa.string())])

    def batch(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, type=f.type) for c, f in zip(zip(*rows), schema)], schema=schema)

    def parsed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i in range(b.num_rows):
                name, data, rows, size = b["path"][i].as_py(), b["content"][i].as_py(), [], 0
                for offset, length, headers, block, reason in salvage(data):
                    payload = None if headers is None else payload_of(headers, block)
                    rows.append((name, offset, length, None if headers is None else list(headers.items()), block, payload, reason))
                    size += length
                    if size >= 8 << 20 or len(rows) >= 2048:
                        yield batch(rows)
                        rows, size = [], 0
                if rows:
                    yield batch(rows)

    return files.mapInArrow(parsed, READ)


def page_records(read: DataFrame) -> DataFrame:
    """(page_id, payload_bytes, payload_digest, record_type, refers_to) of the records read;
    a revisit's size and digest come from its own headers."""
    h = lambda name: F.try_element_at(F.col("headers"), F.lit(name))
    number = lambda c: F.regexp_extract(c, f"{ID}(-?[0-9]+)", 1)
    as_id = lambda c: F.when(number(c) != "", number(c).cast("long"))
    revisit = h("warc-type") == "revisit"
    told = F.regexp_extract(F.col("block").cast("string"), r"(?i)content-length: *([0-9]+)", 1).cast("long")
    return read.filter("quarantined IS NULL").select(
        as_id(h("warc-record-id")).alias("page_id"),
        F.when(revisit, told).otherwise(F.octet_length("payload").cast("long")).alias("payload_bytes"),
        F.when(revisit, F.substring_index(h("warc-payload-digest"), ":", -1)).otherwise(F.sha2("payload", 256)).alias("payload_digest"),
        h("warc-type").alias("record_type"),
        F.when(revisit, as_id(h("warc-refers-to"))).alias("refers_to"),
    )
