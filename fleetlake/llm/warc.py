"""WARC archives: a writer with revisit records and a reader that salvages damaged files.

*Writing*: one record per page, each its own gzip member, in files of bounded size below a shared
folder. Of pages with equal payloads (of at least ``revisit_bytes``) the one with the largest
``page_id`` is stored as a response and the others as revisits of it. A task that is run again
writes new files; only files named in the manifest, which successful tasks return, are read.

*Reading*: a record must pass every check: version line, header form, length, end mark and payload
digest. After a failed check the reader searches for the next gzip member or version line that
begins a valid record, goes on from there, and logs the bytes between as a quarantined gap with the
reason. The same search runs inside the decompressed bytes of a member. What decompresses before an
error or the end of the file is searched, too, also if the member's trailer is wrong, and the rest is a gap.

Offsets and lengths are those in the file. Records of a member, and the gaps inside it, have those of the
member; of a damaged member they reach to where the reading goes on or the file ends.

A null html is an empty payload, a null url leaves out the target, control characters in a url are
escaped. Rows with a null page_id are never the response of a group that has a page_id; repeated
rows of the largest page_id are all responses. Extra columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib
from collections.abc import Callable, Iterator
from functools import partial
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetlake.llm.common import pages, scratch_path, stage

REVISIT_BYTES = 0
FILE_BYTES = 16 << 20
VERSION = b"WARC/1.1\r\n"
MEMBER = b"\x1f\x8b\x08"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


class Record(NamedTuple):
    offset: int
    length: int
    headers: dict[str, str]
    block: bytes


class Gap(NamedTuple):
    offset: int
    length: int
    reason: str


def payload_digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record_bytes(headers: list[tuple[str, str]], block: bytes) -> bytes:
    lines = "".join(f"{k}: {v}\r\n" for k, v in headers).encode()
    return VERSION + lines + f"Content-Length: {len(block)}\r\n\r\n".encode() + block + b"\r\n\r\n"


def member(data: bytes, level: int = 4) -> bytes:
    """One gzip member."""
    packer = zlib.compressobj(level, zlib.DEFLATED, 31)
    return packer.compress(data) + packer.flush()


def http_block(payload: bytes, with_body: bool) -> bytes:
    head = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n"
    return head.encode() + (payload if with_body else b"")


def page_record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None, revisit: bool, date: str) -> bytes:
    name = "null" if page_id is None else str(page_id)
    headers = [
        ("WARC-Type", "revisit" if revisit else "response"),
        ("WARC-Record-ID", f"<urn:page:{name}>"),
        ("WARC-Date", date),
        ("Content-Type", "application/http; msgtype=response"),
        ("WARC-Payload-Digest", "sha1:" + payload_digest(payload)),
    ]
    if url is not None:
        headers.append(("WARC-Target-URI", re.sub(r"[\x00-\x20\x7f-\x9f]", lambda m: f"%{ord(m.group()):02X}", url)))
    if revisit:
        headers += [("WARC-Profile", REVISIT_PROFILE), ("WARC-Refers-To", f"<urn:page:{refers_to}>")]
    return record_bytes(headers, http_block(payload, not revisit))


def _parse(data: bytes, at: int) -> tuple[Record | None, int, str]:
    """The record that begins at ``at``, the position behind it, or the check that failed."""
    if data[at : at + 7] not in (b"WARC/1.", b"WARC/0."):
        return None, at, "no version line"
    end = data.find(b"\r\n\r\n", at)
    if end < 0:
        return None, at, "no end of headers"
    headers: dict[str, str] = {}
    for line in data[at:end].split(b"\r\n")[1:]:
        key, colon, value = line.partition(b":")
        if not colon or not key.strip() or any(c < 32 and c != 9 for c in line):
            return None, at, "bad header line"
        headers[key.strip().decode("latin-1").lower()] = value.strip().decode("utf-8", "replace")
    length = headers.get("content-length", "")
    if not (length.isascii() and length.isdigit() and len(length) < 16):
        return None, at, "bad length"
    start, stop = end + 4, end + 4 + int(length)
    if stop + 4 > len(data):
        return None, at, "truncated block"
    if data[stop : stop + 4] != b"\r\n\r\n":
        return None, at, "no end mark"
    record = Record(at, stop + 4 - at, headers, data[start:stop])
    if headers.get("warc-type") == "response" and headers.get("warc-payload-digest", "").startswith("sha1:"):
        if payload_digest(http_payload(record.block)) != headers["warc-payload-digest"][5:]:
            return None, at, "digest differs"
    return record, stop + 4, ""


def http_payload(block: bytes) -> bytes:
    head, mark, body = block.partition(b"\r\n\r\n")
    return body if mark and head.startswith(b"HTTP/") else block


INFLATE_BYTES = 1 << 16


def _inflate(data: bytes, at: int) -> tuple[bytes, int, str]:
    """What decompresses of the gzip member at ``at``, the position behind it, and what is wrong with it.

    The position is ``at`` if the end of the member is not known.
    """
    unpacker, out = zlib.decompressobj(31), []
    view, i = memoryview(data), at
    try:
        while i < len(data) and not unpacker.eof:
            out.append(unpacker.decompress(view[i : i + INFLATE_BYTES]))
            i += INFLATE_BYTES
    except zlib.error:
        # Once more up to the failing stretch, which is then read byte by byte to have what it gives before the error.
        unpacker, out = zlib.decompressobj(31), []
        try:
            for k in range(at, i, INFLATE_BYTES):
                out.append(unpacker.decompress(view[k : k + INFLATE_BYTES]))
            for k in range(i, min(i + INFLATE_BYTES, len(data))):
                out.append(unpacker.decompress(view[k : k + 1]))
        except zlib.error:
            pass
        return b"".join(out), at, "damaged member"
    if not unpacker.eof:
        return b"".join(out), at, "truncated member"
    return b"".join(out), min(i, len(data)) - len(unpacker.unused_data), ""


class _Marks:
    """Where the next record may begin. Searches only go forward, so what a search found is kept until it is passed,
    and a mark that does not come again is not looked for again: all gaps of a file together read it once per mark."""

    def __init__(self, data: bytes):
        self.data, self.known = data, {}

    def _next(self, name: str, search: Callable[[bytes, int], int], at: int) -> int:
        found = self.known.get(name)
        if found is None or 0 <= found < at:
            found = self.known[name] = search(self.data, at)
        return found

    def next_start(self, at: int, plain_only: bool) -> int:
        """The next version line, or member with one, from ``at`` on; the end of the data if there is none."""
        searches = {f"version {v}": partial(_next_version, version=v) for v in (b"WARC/1.", b"WARC/0.")}
        if not plain_only:
            searches["member"] = _next_member
        starts = [i for name, search in searches.items() if (i := self._next(name, search, at)) >= 0]
        return min(starts) if starts else len(self.data)


def _member(data: bytes, at: int, marks: _Marks) -> tuple[list[Record | Gap], int, str]:
    """Records and gaps of the member at ``at``, the position behind it, and why it has no record."""
    content, behind, damage = _inflate(data, at)
    found = list(_search(content, plain_only=True))
    if not any(isinstance(x, Record) for x in found):
        return [], at, damage or (found[0].reason if found else "empty member")
    if damage:
        # The search goes on inside the damaged bytes.
        behind = marks.next_start(at + 1, False)
        if isinstance(found[-1], Gap):
            found.pop()
        found.append(Gap(at, 0, damage))
    return [x._replace(offset=at, length=behind - at) for x in found], behind, ""


def _step(data: bytes, at: int, plain_only: bool, marks: _Marks) -> tuple[list[Record | Gap], int, str]:
    """What the member, or the plain record, at ``at`` holds."""
    if plain_only or data[at : at + 3] != MEMBER:
        record, behind, why = _parse(data, at)
        return ([record] if record else []), behind, why
    return _member(data, at, marks)


def salvage(data: bytes) -> Iterator[Record | Gap]:
    """Records of an archive in order, and a gap for every stretch of bytes without a valid record."""
    yield from _search(data, plain_only=False)


def _search(data: bytes, plain_only: bool) -> Iterator[Record | Gap]:
    at, gap, reason, marks = 0, None, "", _Marks(data)
    while at < len(data):
        found, behind, why = _step(data, at, plain_only, marks)
        if found:
            if gap is not None:
                yield Gap(gap, at - gap, reason)
                gap = None
            yield from found
            at = behind
            continue
        if gap is None:
            gap, reason = at, why
        at = marks.next_start(at + 1, plain_only)
    if gap is not None:
        yield Gap(gap, len(data) - gap, reason)


def _next_member(data: bytes, at: int) -> int:
    """The next member whose content begins with a version line; chance matches are passed over."""
    while (at := data.find(MEMBER, at)) >= 0:
        try:
            if zlib.decompressobj(31).decompress(memoryview(data)[at : at + 4096], 7) in (b"WARC/1.", b"WARC/0."):
                return at
        except zlib.error:
            pass
        at += 1
    return -1


def _next_version(data: bytes, at: int, version: bytes) -> int:
    found = data.find(b"\n" + version, at - 1)
    return found + 1 if found >= 0 else -1


def roles(source: DataFrame, revisit_bytes: int = REVISIT_BYTES) -> DataFrame:
    """page_id, url, html, refers_to (null for responses) and revisit, for every page."""
    rows = source.select("page_id", "url", F.coalesce("html", F.lit("")).alias("html"))
    keyed = rows.withColumn("sha", F.sha1("html"))
    sums = keyed.where(F.octet_length("html") >= revisit_bytes).groupBy("sha").agg(
        F.max("page_id").alias("top"), F.count("*").alias("n")
    )
    # Only payloads with copies need a partner; the pages are shuffled only if these are many.
    shared = stage(sums.where("n > 1 and top is not null").select("sha", "top"), "warc-copies")
    revisit = F.col("top").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("top"))
    return keyed.join(shared, "sha", "left").select(
        "page_id", "url", "html", F.when(revisit, F.col("top")).alias("refers_to"), revisit.alias("revisit")
    )


def write_warc(source: DataFrame, folder: str, revisit_bytes: int = REVISIT_BYTES, date: str = "2000-01-01T00:00:00Z") -> DataFrame:
    """Write the pages below ``folder`` (any file system Arrow can reach); the manifest is returned.

    The manifest (file, bytes, records) is staged, so the archives are complete on return.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs

        system, base = fs.FileSystem.from_uri(folder)
        system.create_dir(base, recursive=True)
        name, stream, size, count = "", None, 0, 0

        def done() -> pa.RecordBatch:
            stream.close()
            return pa.RecordBatch.from_arrays(
                [pa.array([name]), pa.array([size], pa.int64()), pa.array([count], pa.int64())], names=["file", "bytes", "records"]
            )

        for batch in batches:
            for page_id, url, html, refers_to, revisit in zip(*(c for c in batch.columns)):
                if stream is None:
                    name = f"pages-{uuid.uuid4().hex}.warc.gz"
                    stream, count = system.open_output_stream(f"{base}/{name}", compression=None), 0
                    size = stream.write(member(record_bytes([("WARC-Type", "warcinfo"), ("WARC-Record-ID", f"<urn:file:{name}>"), ("WARC-Date", date), ("Content-Type", "application/warc-fields")], b"format: WARC File Format 1.1\r\n")))
                payload = html.as_py().encode("utf-8", "surrogatepass")
                size += stream.write(member(page_record(page_id.as_py(), url.as_py(), payload, refers_to.as_py(), revisit.as_py(), date)))
                count += 1
                if size >= FILE_BYTES:
                    yield done()
                    stream = None
        if stream is not None:
            yield done()

    return stage(roles(source, revisit_bytes).mapInArrow(run, "file string, bytes long, records long"), "warc-manifest")


RECORDS = (
    "file string, offset long, length long, gap string, record_type string, record_id string, target_uri string, "
    "payload_digest string, payload_bytes long, refers_to string, payload binary"
)


def _content_length(block: bytes) -> int | None:
    found = re.search(rb"(?i)\r\ncontent-length:[ \t]*([0-9]{1,15})\r\n", block[: block.find(b"\r\n\r\n") + 2])
    return int(found.group(1)) if found else None


def read_warc(spark: SparkSession, folder: str, payloads: bool = True, pattern: str = "*.warc*") -> DataFrame:
    """Records and gaps (``gap`` holds the reason, null for records) of all archives in a folder.

    A revisit has no payload of its own; its ``payload_bytes`` is the length its HTTP header states.
    """
    names = [c.split(" ")[0] for c in RECORDS.split(", ")]

    def rows(file: str, data: bytes) -> Iterator[tuple]:
        for found in salvage(data):
            if isinstance(found, Gap):
                yield (file, found.offset, found.length, found.reason, None, None, None, None, None, None, None)
                continue
            h, body = found.headers, http_payload(found.block)
            kind = h.get("warc-type")
            revisit = kind == "revisit"
            yield (
                file, found.offset, found.length, None, kind, h.get("warc-record-id"), h.get("warc-target-uri"),
                h.get("warc-payload-digest", "").removeprefix("sha1:") or None,
                _content_length(found.block) if revisit else len(body),
                h.get("warc-refers-to"), body if payloads and not revisit else None,
            )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        types = [pa.string(), pa.int64(), pa.int64(), *[pa.string()] * 5, pa.int64(), pa.string(), pa.binary()]

        def packed(out: list[tuple]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types)], names=names)

        for batch in batches:
            for path, content in zip(batch.column(0), batch.column(1)):
                out, size = [], 0
                for row in rows(path.as_py(), content.as_py()):
                    out.append(row)
                    size += len(row[-1] or b"") + 200
                    if size > 8 << 20:
                        yield packed(out)
                        out, size = [], 0
                if out:
                    yield packed(out)

    files = spark.read.format("binaryFile").option("pathGlobFilter", pattern).load(folder)
    return files.select(F.element_at(F.split("path", "/"), -1).alias("file"), "content").mapInArrow(run, RECORDS)


def page_rows(records: DataFrame, manifest: DataFrame) -> DataFrame:
    """The contract's columns from what was read back."""
    found = records.where("gap is null and record_type in ('response', 'revisit')").join(manifest.select("file"), "file", "left_semi")
    number = lambda c: F.regexp_extract(c, r"^<urn:page:(-?[0-9]+)>$", 1)
    return found.select(
        number("record_id").try_cast("long").alias("page_id"),
        "payload_bytes",
        "payload_digest",
        "record_type",
        number("refers_to").try_cast("long").alias("refers_to"),
    )


def op9_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = scratch_path(spark, "warc")
    manifest = write_warc(pages(spark, sf_dir), folder)
    return page_rows(read_warc(spark, folder, payloads=False), manifest)


OP9_SQL = r"""
WITH p AS (
  SELECT page_id, coalesce(html, '') AS payload, sha1(coalesce(html, '')) AS h FROM pages
), tops AS (
  SELECT h, max(page_id) AS top FROM p GROUP BY h
)
SELECT page_id, strlen(payload)::BIGINT AS payload_bytes,
       array_to_string(list_transform(range(0, 32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
         ((('0x' || substr(h, (5 * (i // 4) + 1)::BIGINT, 5))::INTEGER >> (5 * (3 - i % 4))::INTEGER) & 31) + 1, 1)), '') AS payload_digest,
       CASE WHEN page_id = top OR top IS NULL THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id = top OR top IS NULL THEN NULL ELSE top END AS refers_to
FROM p JOIN tops USING (h)
"""
