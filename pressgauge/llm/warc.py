"""WARC archives: a writer that stores equal payloads once, and a salvage reader.

The reader checks each record: its version line, header block, Content-Length, the two line ends behind it, and the
SHA-1 digests of block and payload that it claims (``verified`` where there is one of the block). After a failed check
it searches for the next version line or gzip member that starts a valid record, reads on from there, and reports the
bytes between as a gap; a damaged archive gives all its sound records. Plain archives and gzip members of any number of
records are read; members are searched like archives, unzipped a chunk at a time. Of a member that is cut or fails its
own check, the sound records before the fault are kept and the member is a gap. Gaps and records in members also have
their places in the unzipped bytes. An archive is one value of a row, so shorter than 2 GB; beyond it a task holds a
record.

Writer: one record per page, payload the html in UTF-8. Of pages with equal payloads of at least ``least`` bytes the
one with the smallest page_id is a response and the others are revisits that refer to it; smaller ones are all
responses. Payloads are compressed before anything is shuffled. Archives are files of Spark's text sink, RECORDS records each, so any file
system that Spark writes will do: a member's last byte, the highest of its length, is zero, and stands as the sink's
line end; a member of 16 MB or more gets an empty member behind it.

Defined cases: a null html is an empty payload; a null url has no target line; line ends in a url are
percent-encoded; repeated rows of a page are each written as its record, and are responses where its page is; null
page ids come after all others, and a revisit of one has no page to refer to; other columns are not looked at.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import re
import zlib
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pressgauge.session import run_path

#: Records of an archive. An archive is read by one task.
RECORDS = 2000
_STEP = 128
#: Payload bytes of a batch of records that the reader hands on.
BATCH_BYTES = 4 << 20
VERSION = b"WARC/1.1"
_DATE = "2024-01-01T00:00:00Z"
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

#: The longest header block that is looked for, and the longest block that a value of a row can hold.
HEAD_BYTES = 1 << 20
VALUE_BYTES = (1 << 31) - 64

_VERSION_LINE = re.compile(rb"WARC/\d{1,3}\.\d{1,3}\r?\n")
_BEGIN = re.compile(rb"WARC/\d{1,3}\.\d{1,3}\r?\n|\x1f\x8b\x08")
_BLANK = re.compile(rb"\r\n\r\n")
#: No version line is longer.
_LINE = 16
_FEED, _UNZIP = 1 << 16, 1 << 20


def payload_digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None = None, revisit: bool = False) -> bytes:
    """A whole record; a revisit has the HTTP headers of its page without the payload."""
    digest = payload_digest(payload)
    return revisit_record(page_id, url, len(payload), digest, refers_to) if revisit else _framed(
        page_id, url, "response", _http(len(payload)) + payload, digest, [],
    )


def revisit_record(page_id: int | None, url: str | None, size: int, digest: str, refers_to: int | None) -> bytes:
    """A revisit of a payload of which only size and digest are at hand."""
    more = [f"WARC-Refers-To: <urn:page:{'' if refers_to is None else refers_to}>", f"WARC-Profile: {_PROFILE}"]
    return _framed(page_id, url, "revisit", _http(size), digest, more)


def _http(size: int) -> bytes:
    return f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {size}\r\n\r\n".encode()


def _framed(page_id: int | None, url: str | None, kind: str, block: bytes, digest: str, more: list[str]) -> bytes:
    lines = [
        VERSION.decode(), f"WARC-Type: {kind}", f"WARC-Record-ID: <urn:page:{'' if page_id is None else page_id}>", f"WARC-Date: {_DATE}",
    ]
    if url is not None:
        lines.append("WARC-Target-URI: " + url.replace("\r", "%0D").replace("\n", "%0A"))
    lines += [f"WARC-Block-Digest: sha1:{payload_digest(block)}", f"WARC-Payload-Digest: sha1:{digest}", *more]
    lines += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def _member_of(whole: bytes) -> bytes:
    """A record as a gzip member whose last byte, a zero, is left to the sink."""
    member = gzip.compress(whole, mtime=0)
    return (member + gzip.compress(b"", mtime=0) if len(whole) >= 1 << 24 else member)[:-1]


def _responses(page_id: pa.Array, url: pa.Array, html: pa.Array) -> pa.Array:
    out = []
    # A few pages at a time: a batch of all of them, as Python strings and bytes, is several times its size.
    for s in range(0, len(html), _STEP):
        rows = zip(*(c.slice(s, _STEP).to_pylist() for c in (page_id, url, html)))
        out.append(pa.array([_member_of(record(p, u, (h or "").encode())) for p, u, h in rows], type=pa.binary()))
    return pa.concat_arrays(out) if out else pa.array([], type=pa.binary())


def _revisits(page_id: pa.Array, url: pa.Array, size: pa.Array, sha1: pa.Array, first: pa.Array, revisit: pa.Array) -> pa.Array:
    rows = zip(*(c.to_pylist() for c in (page_id, url, size, sha1, first, revisit)))
    return pa.array([
        _member_of(revisit_record(p, u, n, base64.b32encode(bytes.fromhex(d)).decode(), f)) if r else None
        for p, u, n, d, f, r in rows
    ], type=pa.binary())


def write(pages: DataFrame, path: str, least: int = 0) -> None:
    """The pages as archives in a new folder."""
    html = F.coalesce("html", F.lit(""))
    digest, size = F.sha1(html), F.octet_length(html)
    # Ids and digests only.
    firsts = pages.filter(size >= least).groupBy(digest.alias("_digest")).agg(F.min("page_id").alias("_first"))
    rows = pages.select(
        "page_id", "url", digest.alias("_own"), size.alias("_size"), F.arrow_udf(_responses, "binary")("page_id", "url", "html").alias("_member"),
    ).join(firsts, (F.col("_own") == F.col("_digest")) & (F.col("_size") >= least), "left")
    revisit = F.col("_digest").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("_first"))
    other = F.arrow_udf(_revisits, "binary")("page_id", "url", "_size", "_own", "_first", revisit)
    (
        rows.select(F.coalesce(other, "_member").cast("string").alias("value"))
        .write.option("maxRecordsPerFile", RECORDS).option("lineSep", "\0").text(path)
    )


class Damaged(Exception):
    """A failed check of a record."""


class Source:
    """Bytes by their places: a whole buffer, or one that chunks fill and that is dropped behind the reader."""

    def __init__(self, buffer: memoryview | bytearray, chunks: Iterable[bytes] = ()):
        self.buffer, self.base, self.chunks = buffer, 0, iter(chunks)

    def reach(self, end: int) -> bool:
        """Whether there are bytes up to a place."""
        while self.base + len(self.buffer) < end:
            chunk = next(self.chunks, None)
            if chunk is None:
                return False
            self.buffer += chunk
        return True

    def drop(self, at: int) -> None:
        if isinstance(self.buffer, bytearray):
            del self.buffer[:at - self.base]
            self.base = at

    def part(self, start: int, end: int) -> bytes:
        return bytes(self.buffer[start - self.base:end - self.base])

    def find(self, pattern: re.Pattern, at: int, most: int | None = None) -> int:
        """The place of the first match from a place on, or -1; without a limit, what was searched is dropped."""
        begin = at
        while True:
            hit = pattern.search(self.buffer, at - self.base)
            if hit:
                return self.base + hit.start()
            size = self.base + len(self.buffer)
            at = max(at, size - _LINE)
            if most is None:
                self.drop(at)
            elif size - begin > most:
                return -1
            if not self.reach(size + 1):
                return -1


def _parse(source: Source, at: int) -> tuple[dict, int]:
    """The record that begins at a place, and the place behind it."""
    source.reach(at + _LINE)
    line = _VERSION_LINE.match(source.buffer, at - source.base)
    if not line:
        raise Damaged("no version line")
    after = at + line.end() - line.start()
    head_end = source.find(_BLANK, at, HEAD_BYTES)
    if head_end < 0:
        raise Damaged("header block without end")
    fields = {}
    for row in source.part(after, max(after, head_end)).split(b"\r\n"):
        name, colon, value = row.partition(b":")
        if not colon or not name.strip():
            raise Damaged("bad header line")
        fields[name.strip().lower().decode("latin-1")] = value.strip().decode("utf-8", "replace")
    if not re.fullmatch(r"[0-9]{1,18}", fields.get("content-length", "")):
        raise Damaged("no content length")
    start, end = head_end + 4, head_end + 4 + int(fields["content-length"])
    if end - start > VALUE_BYTES or not source.reach(end + 4) or source.part(end, end + 4) != b"\r\n\r\n":
        raise Damaged("no record end behind the block")
    block = source.part(start, end)
    claimed = fields.get("warc-block-digest", "")
    verified = claimed.startswith("sha1:")
    if verified and claimed != f"sha1:{payload_digest(block)}":
        raise Damaged("block digest differs")
    kind = fields.get("warc-type", "")
    http, payload = b"", block
    # Blocks of other types, as those of dns: responses, have no HTTP head; a revisit's may be empty.
    if kind in ("response", "revisit") and block and fields.get("content-type", "").lower().startswith("application/http"):
        http, blank, payload = block.partition(b"\r\n\r\n")
        if not blank:
            raise Damaged("no HTTP header end")
    size = len(payload)
    claimed = fields.get("warc-payload-digest", "").removeprefix("sha1:")
    if kind == "revisit":  # has the payload's digest and length, not the payload
        length = re.search(rb"(?i)\r\ncontent-length:\s*([0-9]{1,18})\s*(?:\r\n|$)", http)
        size = int(length[1]) if length else None
        digest = claimed or None
    else:
        digest = payload_digest(payload)
        if claimed and ":" not in claimed and claimed != digest:
            raise Damaged("payload digest differs")
    return {
        "record_id": fields.get("warc-record-id"), "record_type": kind, "url": fields.get("warc-target-uri"),
        "payload": payload if kind != "revisit" else None, "payload_bytes": size, "payload_digest": digest,
        "refers_to": fields.get("warc-refers-to"), "verified": verified,
    }, end + 4


class Member:
    """The gzip member that begins at a place: its bytes unzipped a chunk at a time, as far as they go, then the place
    behind it or the failed check."""

    def __init__(self, data: memoryview, at: int):
        self.data, self.at, self.end, self.failed = data, at, at, None

    def chunks(self) -> Iterator[bytes]:
        unzip, feed, out = zlib.decompressobj(wbits=31), b"", b""
        while not unzip.eof:
            if not feed:
                feed = self.data[self.end:self.end + _FEED]
                self.end += len(feed)
                if not feed and not out:
                    self.failed = "gzip member without end"
                    return
            before = unzip.copy()
            try:
                out = unzip.decompress(feed, _UNZIP)
            except zlib.error as e:
                self.failed = f"gzip: {e}"
                yield from _until_error(before, feed)
                return
            feed = unzip.unconsumed_tail
            if out:
                yield out
        self.end -= len(unzip.unused_data)

    def rows(self) -> Iterator[dict]:
        """Records and gaps by their places in the unzipped bytes; no gap at the end of a member that fails itself."""
        source, at = Source(bytearray(), self.chunks()), 0
        lost, reason = None, ""
        while source.reach(at + 1):
            try:
                row, after = _parse(source, at)
            except Damaged as e:
                if lost is None:
                    lost, reason = at, str(e)
                at = source.find(_VERSION_LINE, at + 1)
                if at < 0:
                    break
                continue
            if lost is not None:
                yield {"gap": reason, "inner_start": lost, "inner_end": at}
                lost = None
            yield {**row, "inner_start": at, "inner_end": after}
            at = after
            source.drop(at)
        if lost is not None and self.failed is None:
            yield {"gap": reason, "inner_start": lost, "inner_end": source.base + len(source.buffer)}


def _until_error(unzip, feed: bytes) -> Iterator[bytes]:
    """What a failed call would have given before its error."""
    for k in range(len(feed)):
        try:
            yield unzip.decompress(feed[k:k + 1])
        except zlib.error:
            return


def salvage(data: bytes | pa.Buffer) -> Iterator[dict]:
    """Records and gaps of an archive with their places; a gap has the reason of the first failed check. A gap is
    told when its end is known, which is after the records that were recovered from it."""
    data = memoryview(data).cast("B")
    source, at, lost, reason = Source(data), 0, None, ""
    while at < len(data):
        failed = None
        if data[at:at + 3] == b"\x1f\x8b\x08":
            member = Member(data, at)
            for row in member.rows():
                yield {**row, "start": at, "end": member.end}
            failed, after = member.failed, member.end
            rows = []
        else:
            try:
                row, after = _parse(source, at)
                rows = [row]
            except Damaged as e:
                failed = str(e)
        if failed:
            if lost is None:
                lost, reason = at, failed
            hit = _BEGIN.search(data, at + 1)
            at = hit.start() if hit else len(data)
            continue
        if lost is not None:
            yield {"gap": reason, "start": lost, "end": at}
            lost = None
        yield from ({**row, "start": at, "end": after} for row in rows)
        at = after
    if lost is not None:
        yield {"gap": reason, "start": lost, "end": len(data)}


_READ = pa.schema([
    ("archive", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("gap", pa.string()),
    ("record_id", pa.string()), ("record_type", pa.string()), ("url", pa.string()), ("payload", pa.binary()),
    ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("refers_to", pa.string()),
    ("verified", pa.bool_()), ("inner_start", pa.int64()), ("inner_end", pa.int64()),
])
_READ_DDL = (
    "archive string, start bigint, end bigint, gap string, record_id string, record_type string, url string, "
    "payload binary, payload_bytes bigint, payload_digest string, refers_to string, verified boolean, inner_start bigint, "
    "inner_end bigint"
)


def _salvaged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for name, content in zip(batch.column("path"), batch.column("content")):
            rows, size = [], 0
            for row in salvage(content.as_buffer()):
                rows.append({"archive": name.as_py(), **row})
                size += row.get("payload_bytes") or 0
                if size > BATCH_BYTES:
                    yield pa.RecordBatch.from_pylist(rows, schema=_READ)
                    rows, size = [], 0
            yield pa.RecordBatch.from_pylist(rows, schema=_READ)


def read(spark: SparkSession, path: str) -> DataFrame:
    """All records and gaps of the archives in a folder; a gap has its reason in ``gap``, a record null."""
    files = spark.read.format("binaryFile").load(path).select("path", "content")
    return files.mapInArrow(_salvaged, _READ_DDL)


def tables(spark: SparkSession, path: str, out: str) -> tuple[DataFrame, DataFrame]:
    """The records and the gaps of the archives in a folder, written to ``out`` in one reading."""
    (
        read(spark, path).withColumn("kind", F.when(F.col("gap").isNull(), "records").otherwise("gaps"))
        .write.partitionBy("kind").parquet(out)
    )
    every = spark.read.schema(_READ_DDL + ", kind string").parquet(out)
    gaps = every.filter("kind = 'gaps'").select("archive", "start", "end", "inner_start", "inner_end", "gap")
    return every.filter("kind = 'records'").drop("gap", "kind"), gaps


def page_of(urn: str):
    return F.regexp_extract(urn, r"^<urn:page:(-?[0-9]+)>$", 1).try_cast("bigint")


def query(spark: SparkSession, d: str) -> DataFrame:
    path = run_path(spark, "warc")
    write(spark.read.parquet(f"{d}/pages.parquet"), path)
    records = read(spark, path).filter("gap is null")
    return records.select(
        page_of("record_id").alias("page_id"), "payload_bytes", "payload_digest", "record_type",
        page_of("refers_to").alias("refers_to"),
    )


_BITS = "CAST(unhex(sha1(coalesce(html, ''))) AS BIT)::VARCHAR"
SQL = f"""
WITH own AS (
  SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha1(coalesce(html, '')) AS digest, {_BITS} AS bits FROM pages),
firsts AS (SELECT digest, min(page_id) AS first FROM own GROUP BY digest)
SELECT page_id, CAST(payload_bytes AS BIGINT) AS payload_bytes,
  list_aggregate(list_transform(range(0, 32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', CAST(1
    + 16 * CAST(substr(bits, CAST(5 * i + 1 AS BIGINT), 1) AS INT) + 8 * CAST(substr(bits, CAST(5 * i + 2 AS BIGINT), 1) AS INT)
    + 4 * CAST(substr(bits, CAST(5 * i + 3 AS BIGINT), 1) AS INT) + 2 * CAST(substr(bits, CAST(5 * i + 4 AS BIGINT), 1) AS INT)
    + CAST(substr(bits, CAST(5 * i + 5 AS BIGINT), 1) AS INT) AS BIGINT), 1)), 'string_agg', '') AS payload_digest,
  CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id = first THEN NULL ELSE first END AS refers_to
FROM own JOIN firsts USING (digest)
"""
