"""WARC archives of pages, and a reader that goes on after damage.

An archive is a file of gzip members, one record each.  Spark's text sink writes
it: a row is a whole file, and the NUL with which it ends a row is padding that
gzip readers skip.  The reader takes a file at a time, so files have a set size.
"""

from __future__ import annotations

import base64
import hashlib
import re
import zlib
from collections.abc import Iterator
from uuid import UUID, uuid4

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from salesmart.llm.batches import map_batches, schema_of, slices
from salesmart.sources.shared import shared_dir, store

#: Smaller payloads are never replaced by a reference.
LEAST_BYTES = 100
#: An archive is closed at this size; a record that is larger is alone.
ARCHIVE_BYTES = 16_000_000
#: Compressed bytes given to the decompressor at once.
_FEED = 1 << 16
_MAGIC = b"\x1f\x8b\x08"
# Algorithms by which a digest can be checked.
_DIGESTS = ("md5", "sha1", "sha256", "sha512")
_VERSION = re.compile(rb"(?:(?<=\n)|\A)WARC/1\.[01]\r\n")
_HTTP = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"

FOUND = (
    "path string, kind string, start long, end long, reason string, record_type string, record_id string, "
    "refers_to string, target_uri string, payload_digest string, payload_bytes long, payload binary"
)


def with_references(pages: DataFrame) -> DataFrame:
    """``pages`` with payload_digest, payload_bytes and ``first``: the smallest
    page_id of those with this payload, if there are several and it is large
    enough, else null.  Rows of one page_id are rows each: if it is the smallest,
    all of them are responses, with one record id.

    A null html is empty.  The table of firsts is stored, so that both sides of
    the join are plain exchanges and a payload of very many pages is split.
    """
    payload = F.coalesce(F.col("html"), F.lit(""))
    made = ("payload_digest", "payload_bytes", "first")
    own = pages.drop(*made).withColumns({"payload_digest": F.sha2(payload, 256), "payload_bytes": F.octet_length(payload).cast("long")})
    several = own.where(F.col("payload_bytes") >= LEAST_BYTES).groupBy("payload_digest").agg(
        F.min("page_id").alias("first"), F.count(F.lit(1)).alias("n")
    )
    firsts = store(several.where("n > 1 AND first IS NOT NULL").select("payload_digest", "first"), "warc-firsts")
    return own.join(firsts, "payload_digest", "left")


def record_id(page_id: int | None, digest: str) -> str:
    """A page's id in the form of a UUID, from which it can be read back."""
    return f"<urn:uuid:{UUID(digest[:32]) if page_id is None else UUID(int=page_id & _TOP)}>"


def page_of(urn: str | None) -> int | None:
    """The page_id in a record id; null if there is none in it."""
    try:
        value = UUID(urn.strip("<>")).int if urn else -1
    except ValueError:
        return None
    return None if not 0 <= value <= _TOP else value - (1 << 64) if value >> 63 else value


_TOP = (1 << 64) - 1


def record(page_id: int | None, url: str | None, html: str | None, digest: str, first: int | None) -> bytes:
    """One record as a gzip member: a revisit if another page came first."""
    payload = (html or "").encode("utf-8", "surrogatepass")
    revisit = first is not None and first != page_id
    block = _HTTP if revisit else _HTTP + payload
    uri = "".join(c if c > " " else f"%{ord(c):02X}" for c in url or f"urn:page:{page_id}")
    lines = [
        f"WARC-Type: {'revisit' if revisit else 'response'}",
        f"WARC-Record-ID: {record_id(page_id, digest)}",
        "WARC-Date: 1970-01-01T00:00:00Z",
        f"WARC-Target-URI: {uri}",
        f"WARC-Payload-Digest: sha256:{digest}",
        f"WARC-Payload-Length: {len(payload)}",
        f"WARC-Block-Digest: sha256:{hashlib.sha256(block).hexdigest()}",
        "Content-Type: application/http; msgtype=response",
        f"Content-Length: {len(block)}",
    ]
    if revisit:
        lines += [
            "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest",
            f"WARC-Refers-To: {record_id(first, digest)}",
        ]
    raw = "WARC/1.1\r\n" + "\r\n".join(lines) + "\r\n\r\n"
    deflate = zlib.compressobj(6, zlib.DEFLATED, 31)
    return deflate.compress(raw.encode("utf-8", "surrogatepass") + block + b"\r\n\r\n") + deflate.flush()


def write_archives(pages: DataFrame, path: str, archive_bytes: int = ARCHIVE_BYTES) -> None:
    """A record for each row of ``pages`` (page_id, url, html), in files below
    ``path``.  Spark's committer keeps one attempt of each task."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[bytes] = []
        size = 0
        for batch in batches:
            for part in slices(batch):
                for row in zip(*(c.to_pylist() for c in part.columns), strict=True):
                    member = record(*row)
                    if held and size + len(member) > archive_bytes:
                        yield _blob(held)
                        held, size = [], 0
                    held.append(member)
                    size += len(member)
        if held:
            yield _blob(held)

    rows = with_references(pages).select("page_id", "url", "html", "payload_digest", "first")
    archives = map_batches(rows, pack, "value binary").select(F.col("value").cast("string").alias("value"))
    archives.write.option("maxRecordsPerFile", 1).option("lineSep", "\0").text(path)


def _blob(members: list[bytes]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([b"".join(members)], pa.binary())], names=["value"])


def _member(data: memoryview, at: int) -> tuple[bytes, int] | None:
    """Content and end of a gzip member whose checksum and length hold."""
    inflate = zlib.decompressobj(31)
    out, end = [], at
    try:
        while not inflate.eof:
            chunk = data[end : end + _FEED]
            if not chunk:
                return None
            out.append(inflate.decompress(chunk))
            end += len(chunk)
    except zlib.error:
        return None
    return b"".join(out), end - len(inflate.unused_data)


def _record(raw: bytes, at: int) -> tuple[dict[str, str], bytes, int] | str:
    """Fields, block and end of the record at ``at``, or what is wrong with it."""
    if not _VERSION.match(raw, at):
        return "no version line"
    head = raw.find(b"\r\n\r\n", at)
    if head < 0:
        return "no end of header"
    fields = {}
    for line in raw[at:head].split(b"\r\n")[1:]:
        name, colon, value = line.partition(b":")
        if not colon:
            return "header line without a name"
        fields[name.strip().lower().decode("utf-8", "replace")] = value.strip().decode("utf-8", "replace")
    length = fields.get("content-length", "")
    if not (length.isascii() and length.isdigit()):
        return "no content length"
    end = head + 4 + int(length)
    block = raw[head + 4 : end]
    if raw[end : end + 4] != b"\r\n\r\n":
        return "no end of record"
    if _differs(block, fields.get("warc-block-digest", "")):
        return "block digest differs"
    return fields, block, end + 4


def _differs(block: bytes, named: str) -> bool:
    """Whether a digest, in hexadecimal digits or base32, is not the block's.  One
    by an unknown algorithm says nothing."""
    algorithm, _, digest = named.partition(":")
    algorithm = algorithm.strip().lower().replace("-", "")
    if algorithm not in _DIGESTS or not digest.strip():
        return False
    own = hashlib.new(algorithm, block).digest()
    return digest.strip().rstrip("=").lower() not in (own.hex(), base64.b32encode(own).decode().rstrip("=").lower())


def _records(raw: bytes) -> Iterator[tuple[int, int, str | None, dict[str, str], bytes]]:
    """Records and gaps of a member's content, as ``salvage`` gives them: after a
    failed check it goes on at the next version line whose record holds."""
    at, gap, why = 0, -1, ""
    while at < len(raw):
        if gap < 0 and raw.startswith(b"\r\n", at):  # padding
            at += 2
            continue
        found = _record(raw, at)
        if isinstance(found, str):
            if gap < 0:
                gap, why = at, found
            later = _next_version(raw, at + 1)
            at = later if later >= 0 else len(raw)
            continue
        if gap >= 0:
            yield gap, at, why, {}, b""
            gap = -1
        fields, block, end = found
        yield at, end, None, fields, block
        at = end
    if gap >= 0:
        yield gap, len(raw), why, {}, b""


def salvage(data: bytes) -> Iterator[tuple[int, int, str | None, dict[str, str], bytes]]:
    """(start, end, reason, fields, block) for all records and gaps of an archive,
    in order.  reason is null for a record; for a gap it says what failed first.

    After a failed check the search goes on one byte later for the next member
    that holds or, in an uncompressed archive, the next version line whose record
    holds.  A member that holds may have any number of records; all have the
    member's offsets, and the reason of a gap among them says which bytes of the
    content it is.  A member without content is padding.
    """
    view, at, gap, why = memoryview(data), 0, -1, ""
    while at < len(data):
        if gap < 0 and (data[at] == 0 or data[at : at + 2] == b"\r\n"):  # padding
            at += 1 if data[at] == 0 else 2
            continue
        if data.startswith(_MAGIC, at):
            member = _member(view, at)
            found = "member does not hold"
            if member is not None:
                # The member holds, so the next one begins behind it.
                content, end = member
                parts = list(_records(content))
                if any(reason is None for _, _, reason, _, _ in parts) or not parts:
                    if gap >= 0:
                        yield gap, at, why, {}, b""
                    for a, b, reason, fields, block in parts:
                        yield at, end, reason and f"{reason} (bytes {a} to {b} of the content)", fields, block
                else:
                    yield (at, end, parts[0][2], {}, b"") if gap < 0 else (gap, end, why, {}, b"")
                at, gap = end, -1
                continue
        else:
            found = _record(data, at)
        if isinstance(found, str):
            if gap < 0:
                gap, why = at, found
            marks = [m for m in (data.find(_MAGIC, at + 1), _next_version(data, at + 1)) if m >= 0]
            at = min(marks, default=len(data))
            continue
        fields, block, end = found
        if gap >= 0:
            yield gap, at, why, {}, b""
            gap = -1
        yield at, end, None, fields, block
        at = end
    if gap >= 0:
        yield gap, len(data), why, {}, b""


def _next_version(data: bytes, at: int) -> int:
    found = _VERSION.search(data, at)
    return found.start() if found else -1


def read_archives(spark: SparkSession, path: str, payloads: bool = True) -> DataFrame:
    """Records (kind 'record') and quarantined bytes (kind 'gap') of the archives at
    ``path``.  ``start`` and ``end`` are byte offsets in the file.

    payload_digest and payload_bytes of a response are taken from the payload that
    was read; those of a revisit are what its header says.  ``payloads``: whether
    the bytes are returned as well.  A file is read whole by one task, so it may have
    2 GB at most (Spark fails on a larger one).
    """
    schema = schema_of(FOUND)

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        types = {"string": pa.string(), "long": pa.int64(), "binary": pa.binary()}
        kinds = [types[f.split(" ")[1]] for f in FOUND.split(", ")]
        for batch in batches:
            for i in range(batch.num_rows):
                name, rows, size = batch.column(0)[i].as_py(), [], 0
                for start, end, reason, fields, block in salvage(batch.column(1)[i].as_py()):
                    if reason is not None:
                        rows.append((name, "gap", start, end, reason, *[None] * 7))
                        continue
                    body = block.partition(b"\r\n\r\n")[2] if "http" in fields.get("content-type", "") else block
                    revisit = fields.get("warc-type") == "revisit"
                    digest = fields.get("warc-payload-digest", "").rpartition(":")[2] if revisit else hashlib.sha256(body).hexdigest()
                    length = int(fields.get("warc-payload-length") or 0) if revisit else len(body)
                    rows.append(
                        (name, "record", start, end, None, fields.get("warc-type"), fields.get("warc-record-id"), fields.get("warc-refers-to"),
                         fields.get("warc-target-uri"), digest, length, body if payloads else None)
                    )
                    size += len(body)
                    if size > ARCHIVE_BYTES:
                        yield _batch(rows, kinds, schema.names)
                        rows, size = [], 0
                yield _batch(rows, kinds, schema.names)

    files = spark.read.format("binaryFile").load(path).select("path", "content")
    return map_batches(files, parse, schema)


def _batch(rows: list[tuple], kinds: list[pa.DataType], names: list[str]) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) or [()] * len(kinds)
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=names)


def gap_log(found: DataFrame) -> DataFrame:
    """The quarantined bytes of what ``read_archives`` found, to be kept as a log."""
    gaps = found.where("kind = 'gap'")
    return gaps.select("path", "start", "end", (F.col("end") - F.col("start")).alias("bytes"), "reason")


def whole_records(found: DataFrame) -> DataFrame:
    """The records of archives that must not have gaps: one is an error."""
    place = F.concat_ws(" ", F.lit("gap in"), "path", "start", "end", "reason")
    kind = F.when(F.col("kind") == "gap", F.raise_error(place).cast("string")).otherwise(F.col("kind"))
    return found.where(kind == "record")


def archived(pages: DataFrame) -> DataFrame:
    """``pages`` through archives in the shared folder: what ``read_archives`` finds,
    without payloads.  No page: no row."""
    spark = pages.sparkSession
    path = f"{shared_dir(spark)}/warc-{uuid4().hex}"
    write_archives(pages, path)
    return read_archives(spark, path, payloads=False)
