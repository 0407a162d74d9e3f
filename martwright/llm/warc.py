"""WARC archives: a writer with payload deduplication and a reader that salvages damaged archives.

Writing: every record is one gzip member. Spark's text sink writes the bytes (an empty gzip member
separates two records), so archives go wherever Spark can write, with its commit protocol. Of equal
payloads the page with the smallest id is a ``response``; the others are ``revisit`` records without
payload that refer to it.

Reading: whole archives (``records_per_archive`` keeps them small) are scanned member by member. A record
counts only if its member's checksum, its lengths and its digests hold. After a failed check the
reader looks for the next valid member or version line, goes on there and reports the bytes between as a gap. Inside a
member it does the same with version lines, so one bad record costs no good one; of a member that is damaged itself, records
with a block digest count if more content follows them. The reader takes time in proportion to the archive.

Defined results: NULL html is an empty payload. Pages that share id and payload are all responses; a page
with a NULL id never becomes the referred one unless all of its kind have none. NULL urls leave the
target out. Pages of any length are one record. Extra columns are not read. Empty tables write an archive without records.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import re
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from martwright.llm.text import runs_of

MEMBER = b"\x1f\x8b\x08"
VERSION = re.compile(rb"WARC/1\.[01]\r\n")
# Fields that every record must have; and the digest, without which a damaged member proves nothing.
NEEDED = {"warc-type", "warc-record-id", "warc-date", "content-length", "warc-block-digest"}
EMPTY_MEMBER = gzip.compress(b"", mtime=0).decode("latin-1")
READ = (
    "archive string, offset long, length long, kind string, record_type string, page_id long, refers_to long, "
    "target string, claimed string, payload_bytes long, payload_digest string, payload binary, gap_offset long, gap_length long"
)


def base32_sha1(payload: Column) -> Column:
    """SHA-1 in upper-case base32: five bytes at a time, as eight digits of radix 32."""
    digest = F.sha1(payload)
    digits = F.concat(*[F.lpad(F.conv(F.substring(digest, 1 + 10 * i, 10), 16, 32), 8, "0") for i in range(4)])
    return F.translate(digits, "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567")


def sha1(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def with_records(pages: DataFrame, min_bytes: int = 0) -> DataFrame:
    """Pages with ``payload``, ``payload_digest``, ``record_type`` and ``refers_to``."""
    html = F.coalesce(F.col("html"), F.lit("")).cast("binary")
    rows = pages.select("page_id", "url", html.alias("payload"))
    rows = rows.withColumn("payload_digest", base32_sha1(F.col("payload")))
    # only digests and ids meet in the grouping; it collapses copies map-side
    firsts = (
        rows.filter(F.octet_length("payload") >= min_bytes)
        .groupBy(F.col("payload_digest").alias("of"))
        .agg(F.min("page_id").alias("first"), F.count("*").alias("n"))
        .filter("n > 1 AND first IS NOT NULL")
        .drop("n")
    )
    again = F.col("first").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first"))
    return rows.join(firsts, F.col("payload_digest") == F.col("of"), "left").select(
        "page_id", "url", "payload", "payload_digest",
        F.when(again, "revisit").otherwise("response").alias("record_type"),
        F.when(again, F.col("first")).alias("refers_to"),
    )


def record(page_id: int | None, url: str | None, payload: bytes, digest: str, kind: str, refers_to: int | None, date: str) -> bytes:
    """The bytes of one WARC record; a revisit's block is the HTTP header alone."""
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    block = http + payload if kind == "response" else http
    fields = [
        ("WARC-Type", kind),
        ("WARC-Record-ID", f"<urn:page:{'none' if page_id is None else page_id}>"),
        ("WARC-Date", date),
        ("WARC-Payload-Digest", f"sha1:{digest}"),
        ("WARC-Block-Digest", f"sha1:{sha1(block)}"),
        ("Content-Type", "application/http; msgtype=response"),
        ("Content-Length", str(len(block))),
    ]
    if url is not None:
        fields.append(("WARC-Target-URI", re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url)))
    if kind == "revisit":
        fields += [
            ("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"),
            ("WARC-Refers-To", f"<urn:page:{refers_to}>"),
        ]
    head = "".join(f"{k}: {v}\r\n" for k, v in fields).encode()
    return b"WARC/1.1\r\n" + head + b"\r\n" + block + b"\r\n\r\n"


def _members(date: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["page_id", "url", "payload", "payload_digest", "record_type", "refers_to"]
        for batch in runs_of(batches, 4_000_000, "payload"):
            rows = zip(*[batch.column(n).to_pylist() for n in names], strict=True)
            members = [gzip.compress(record(*row, date), 6, mtime=0) for row in rows]
            for k in range(0, len(members), 256):
                yield pa.RecordBatch.from_arrays([pa.array(members[k : k + 256], pa.binary())], names=["member"])

    return run


def write(records: DataFrame, path: str, records_per_archive: int = 2000, date: str = "2020-01-01T00:00:00Z") -> None:
    """Write the rows of ``with_records`` as gzip WARC archives below ``path``."""
    members = records.mapInArrow(_members(date), "member binary")
    (
        members.select(F.col("member").cast("string"))
        .write.option("lineSep", EMPTY_MEMBER)
        .option("encoding", "ISO-8859-1")
        .option("maxRecordsPerFile", records_per_archive)
        .text(path)
    )


def parse(data: bytes, at: int) -> tuple[int, dict, bytes] | None:
    """The record whose version line is at ``at``: its end, its fields and its block; None if a check fails."""
    version = VERSION.match(data, at)
    stop = data.find(b"\r\n\r\n", at) if version else -1
    if stop < 0:
        return None
    fields = {}
    for line in data[version.end() : stop].split(b"\r\n"):
        name, colon, value = line.partition(b":")
        if not colon:
            return None
        fields[name.strip().lower().decode("latin-1")] = value.strip().decode("utf-8", "replace")
    length = fields.get("content-length", "")
    if not (length.isascii() and length.isdigit()):
        return None
    end = stop + 4 + int(length)
    block = data[stop + 4 : end]
    if len(block) < int(length) or data[end : end + 4] != b"\r\n\r\n":
        return None
    if fields.get("warc-block-digest", "sha1:" + sha1(block)) != "sha1:" + sha1(block):
        return None
    payload = block.partition(b"\r\n\r\n")[2] if fields.get("content-type", "").startswith("application/http") else block
    claimed = fields.get("warc-payload-digest")
    if fields.get("warc-type") == "response" and claimed is not None and claimed != "sha1:" + sha1(payload):
        return None
    return end + 4, fields, payload


def member_at(data: bytes, at: int) -> tuple[int | None, bytes]:
    """End and content of the gzip member at ``at``; of a damaged or cut-off one no end, and what could be inflated.

    The inflater gets small pieces that grow, so what it leaves over, which zlib copies, is never longer than the member itself
    or the first piece.
    """
    def inflate(at: int, piece: int, largest: int) -> tuple[int | None, bytes]:
        stream, view, content = zlib.decompressobj(31), memoryview(data), []
        try:
            while at < len(data) and not stream.eof:
                content.append(stream.decompress(view[at : at + piece]))
                at, piece = min(at + piece, len(data)), min(2 * piece, largest)
        except zlib.error:
            return None, b"".join(content)
        return at - len(stream.unused_data) if stream.eof else None, b"".join(content)

    end, content = inflate(at, 4096, 1 << 16)
    # a piece that fails gives nothing, so a damaged member is inflated again in small ones
    return (end, content) if end is not None else inflate(at, 16, 16)


def records_in(content: bytes) -> tuple[list[tuple[int, dict, bytes]], list[tuple[int, int]]]:
    """Records of a member (with their ends), and the gaps between them as offset and length inside the content."""
    found, gaps, at, bad = [], [], 0, None
    while at < len(content):
        one = parse(content, at)
        if one is None:
            bad = at if bad is None else bad
            version = VERSION.search(content, at + 1)
            at = version.start() if version else len(content)
            continue
        if bad is not None:
            gaps.append((bad, at - bad))
            bad = None
        at = one[0]
        found.append(one)
    return found, [*gaps, (bad, len(content) - bad)] if bad is not None else gaps


def salvage(data: bytes) -> Iterator[tuple[int, int, str, dict, bytes]]:
    """``(offset, length, kind, fields, payload)`` over a whole archive, in order; kind is "record", "gap", or "gap inside".

    A gap is a stretch of the archive that yields nothing. A gap inside a member that also holds good records has the
    member's place, and its own place in the inflated content as ``fields``. Of a damaged member those records count that are
    followed by more content: the last one may be what the damage cut short.
    """
    at, bad = 0, None
    kept: list[tuple[int, dict, bytes]] = []  # from the damaged member that begins the gap
    inside: list[tuple[int, int]] = []

    def close(end: int) -> Iterator[tuple[int, int, str, dict, bytes]]:
        if bad is not None and not kept:
            yield bad, end - bad, "gap", {}, b""
        for _, fields, payload in kept:
            yield bad, end - bad, "record", fields, payload
        for start, length in inside if kept else []:
            yield bad, end - bad, "gap inside", {"offset": start, "length": length}, b""

    while at < len(data):
        end, records, gaps = None, [], []
        if data.startswith(MEMBER, at):
            end, content = member_at(data, at)
            records, gaps = records_in(content)
            if end is None:
                records = [r for r in records if r[0] < len(content) and NEEDED <= r[1].keys()]
                last = records[-1][0] if records else 0
                gaps = [g for g in gaps if g[0] < last] + [(last, len(content) - last)]
            elif content and not records:
                end = None
        elif one := parse(data, at):
            end, records = one[0], [one]
        if end is not None:
            yield from close(at)
            bad, kept, inside = None, [], []
            for _, fields, payload in records:
                yield at, end - at, "record", fields, payload
            for start, length in gaps:
                yield at, end - at, "gap inside", {"offset": start, "length": length}, b""
            at = end
            continue
        if records:
            yield from close(at)
            bad, kept, inside = at, records, gaps
        bad = at if bad is None else bad
        # what a damaged member holds has been looked at in inflated form; only the next member may follow it
        version = None if kept else VERSION.search(data, at + 1)
        nexts = [x for x in (data.find(MEMBER, at + 1), version.start() if version else -1) if x >= 0]
        at = min(nexts, default=len(data))
    yield from close(len(data))


def _page(urn: str | None) -> int | None:
    found = re.fullmatch(r"<urn:page:(-?\d+)>", urn or "")
    return int(found[1]) if found else None


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = [x.split()[0] for x in READ.split(", ")]
    kinds = [pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.binary(), pa.int64(), pa.int64()]

    def batch_of(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names=names)

    for batch in batches:
        for path, content in zip(batch.column("path").to_pylist(), batch.column("content"), strict=True):
            rows, held = [], 0
            for offset, length, kind, fields, payload in salvage(content.as_py()):
                kept = kind == "record" and fields.get("warc-type") == "response"
                rows.append((
                    path, offset, length, kind, fields.get("warc-type"), _page(fields.get("warc-record-id")), _page(fields.get("warc-refers-to")),
                    fields.get("warc-target-uri"), fields.get("warc-payload-digest", "").removeprefix("sha1:"), len(payload) if kept else None, sha1(payload) if kept else None, payload if kept else None,
                    fields.get("offset"), fields.get("length"),
                ))
                held += len(payload)
                if held > 8_000_000:
                    yield batch_of(rows)
                    rows, held = [], 0
            if rows:
                yield batch_of(rows)


def read(spark: SparkSession, path: str) -> DataFrame:
    """Records and gaps of all archives below ``path``; one row each, ``kind`` tells which."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path).select("path", "content")
    return files.mapInArrow(_read, READ)


def resolved(found: DataFrame) -> DataFrame:
    """One row per record; a revisit takes size and digest of its payload from the response it refers to."""
    records = found.filter("kind = 'record'")
    targets = (
        records.filter("record_type = 'response' AND page_id IS NOT NULL")
        .groupBy(F.col("page_id").alias("of"), F.col("payload_digest").alias("digest"))
        .agg(F.first("payload_bytes").alias("bytes"))
    )
    responses = records.filter("record_type = 'response'").select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
    revisits = records.filter("record_type = 'revisit'").join(
        targets, (F.col("refers_to") == F.col("of")) & (F.col("claimed") == F.col("digest")), "left"
    )
    return responses.unionByName(
        revisits.select("page_id", F.col("bytes").alias("payload_bytes"), F.col("digest").alias("payload_digest"), "record_type", "refers_to")
    )
