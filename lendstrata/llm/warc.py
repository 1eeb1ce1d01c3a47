"""WARC archives of web pages: writing with revisits, and a reader that salvages.

Archives are files of gzip members, one record each, that Spark writes and commits, so they can
lie wherever Spark can write. Tasks hand Spark chunks of whole members as text; the line
separator that its text writer puts behind each is an empty gzip member, which readers skip.

The reader takes such archives, plain ones, and gzipped ones with several records a member.
A record must be framed by its Content-Length and agree with its digests. Where one does not,
the reader searches for the next gzip member or version line at which whole records can be
read again, goes on from there, and reports the bytes between as a gap.
"""

from __future__ import annotations

import base64
import hashlib
import re
import zlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from lendstrata.operators.skew import replicate_rows

from .common import discard, stage_at

CHUNK_BYTES, CHUNKS_PER_ARCHIVE = 4 << 20, 16
GZIP = 16 + zlib.MAX_WBITS
FED = 1 << 16
SCHEMA = (
    "archive string, offset long, length long, reason string, record_type string, record_id string, "
    "target_uri string, refers_to string, payload_digest string, payload_bytes long, payload binary"
)
_FIELDS = [column.split()[0] for column in SCHEMA.split(",")]
_KINDS = {"string": pa.string(), "long": pa.int64(), "binary": pa.binary()}
_TYPES = [_KINDS[column.split()[1]] for column in SCHEMA.split(",")]

# Fixed values of the format.
VERSION_LINE = re.compile(rb"WARC/1\.[01]\r\n")
RECORD_STARTS = re.compile(rb"\x1f\x8b\x08|WARC/1\.[01]\r\n")
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
HTTP_TYPE = "application/http; msgtype=response"
_NO_URI = re.compile(rb"[\x00-\x20\x7f-\xff]")


def gzipped(data: bytes, level: int = 6) -> bytes:
    """One gzip member without a time, so that equal records have equal bytes."""
    packer = zlib.compressobj(level, zlib.DEFLATED, GZIP)
    return packer.compress(data) + packer.flush()


SEPARATOR = gzipped(b"")


def base32_sha1(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def page_urn(page_id: int | None, digest: str) -> str:
    """A record's id; equal for rows that repeat both id and payload."""
    return f"urn:page:{'' if page_id is None else page_id}:{digest}"


def page_of(urn: str | None) -> int | None:
    found = re.fullmatch(r"urn:page:(-?\d+):\w+", urn or "")
    return int(found[1]) if found else None


def written(headers: dict[str, str], block: bytes) -> bytes:
    """A record as it stands in a plain archive."""
    lines = "".join(f"{name}: {value}\r\n" for name, value in headers.items())
    return f"WARC/1.1\r\n{lines}Content-Length: {len(block)}\r\n\r\n".encode() + block + b"\r\n\r\n"


def page_record(page_id: int | None, url: str | None, payload: bytes | None, size: int, digest: str, refers_to: str | None, date: str) -> bytes:
    """A response, or a revisit where ``payload`` is None. A URL's white space, control
    characters and characters beyond ASCII are percent-encoded; a page without URL has its own
    id as target."""
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % size
    block = http + (payload or b"")
    own = page_urn(page_id, digest)
    target = own if not url else _NO_URI.sub(lambda m: b"%%%02X" % m[0][0], url.encode()).decode()
    headers = {"WARC-Type": "response" if payload is not None else "revisit", "WARC-Record-ID": f"<{own}>", "WARC-Date": date, "WARC-Target-URI": target}
    if payload is None:
        headers |= {"WARC-Refers-To": f"<{refers_to}>", "WARC-Profile": REVISIT_PROFILE}
    headers |= {"WARC-Payload-Digest": f"sha1:{digest}", "WARC-Block-Digest": f"sha1:{base32_sha1(block)}", "Content-Type": HTTP_TYPE}
    return written(headers, block)


class Damaged(ValueError):
    """No whole record at this place, and why."""


@dataclass
class Record:
    headers: dict[str, str]
    block: bytes

    def header(self, name: str) -> str | None:
        return self.headers.get(name.lower())

    @property
    def is_http(self) -> bool:
        return (self.header("Content-Type") or "").startswith("application/http")

    def payload(self) -> bytes | None:
        """What the record carries: the body of an HTTP message, nothing in a revisit, else
        the block."""
        if self.header("WARC-Type") == "revisit":
            return None
        return self.block.partition(b"\r\n\r\n")[2] if self.is_http else self.block

    def payload_bytes(self) -> int | None:
        """Bytes of the payload; those of a revisit are told by its HTTP headers."""
        carried = self.payload()
        if carried is not None:
            return len(carried)
        told = re.search(rb"(?im)^content-length:[ \t]*(\d+)[ \t]*\r?$", self.block.partition(b"\r\n\r\n")[0])
        return int(told[1]) if told else None


def _checked(record: Record) -> Record:
    """The record, if it has a kind and an id and agrees with its SHA-1 digests; other kinds of
    digest are not looked at."""
    for name in ("WARC-Type", "WARC-Record-ID"):
        if not record.header(name):
            raise Damaged(f"no {name}")
    for name, data in (("WARC-Block-Digest", record.block), ("WARC-Payload-Digest", record.payload())):
        kind, _, told = (record.header(name) or "").partition(":")
        if kind.lower() == "sha1" and data is not None and told.upper() != base32_sha1(data):
            raise Damaged(f"{name} differs")
    return record


def plain_record(data: bytes, at: int) -> tuple[Record, int]:
    """The record of a plain archive at ``at``, and where it ends."""
    version = VERSION_LINE.match(data, at)
    if not version:
        raise Damaged("no version line")
    # a record without headers has its empty line directly behind the version line
    behind = data.find(b"\r\n\r\n", version.end() - 2)
    if behind < 0:
        raise Damaged("headers do not end")
    if VERSION_LINE.search(data, version.end(), behind + 2):
        raise Damaged("headers run into the next record")
    headers: dict[str, str] = {}
    last = None
    for line in data[version.end() : max(behind, version.end())].decode("utf-8", "replace").split("\r\n"):
        name, colon, value = line.partition(":")
        if line[:1] in (" ", "\t") and last:  # the header before goes on
            headers[last] += " " + line.strip()
        elif colon:
            last = name.strip().lower()
            headers[last] = value.strip()
    told = headers.get("content-length", "")
    if not re.fullmatch("[0-9]{1,18}", told):
        raise Damaged("no content length")
    start = behind + 4
    end = start + int(told)
    if data[end : end + 4] != b"\r\n\r\n":
        raise Damaged("truncated" if end + 4 > len(data) else "content length differs")
    return _checked(Record(headers, data[start:end])), end + 4


def unzipped(data: bytes, at: int) -> tuple[bytes, int]:
    """Content of the gzip member at ``at``, and where it ends; its checksum holds. A member
    that does not begin as a record does is given up at once."""
    unpacker, parts, fed, known = zlib.decompressobj(GZIP), [], at, 0
    view = memoryview(data)
    try:
        while not unpacker.eof:
            if fed >= len(data):
                raise Damaged("truncated")
            parts.append(unpacker.decompress(view[fed : fed + FED]))
            fed += FED
            if known < 5:
                begun = b"".join(parts)[:5]
                known = len(begun)
                if not b"WARC/".startswith(begun):
                    raise Damaged("member of something else")
    except zlib.error as e:
        raise Damaged(f"gzip member: {e}") from None
    return b"".join(parts), min(fed, len(data)) - len(unpacker.unused_data)


def records_at(data: bytes, at: int) -> tuple[list[Record], int]:
    """The records of the gzip member at ``at``, or the plain record there, and where what was
    read ends. An empty member has none."""
    if data[at : at + 2] != b"\x1f\x8b":
        record, end = plain_record(data, at)
        return [record], end
    content, end = unzipped(data, at)
    found, inside = [], 0
    while inside < len(content):
        record, inside = plain_record(content, inside)
        found.append(record)
    return found, end


def salvage(data: bytes) -> Iterator[tuple[int, int, list[Record], str | None]]:
    """``(start, end, records, None)`` of each member or plain record of an archive that can be
    read, and ``(start, end, [], reason)`` of each gap between them."""
    at = 0
    while at < len(data):
        try:
            found, end = records_at(data, at)
        except Damaged as damage:
            for candidate in RECORD_STARTS.finditer(data, at + 1):
                try:
                    found, end = records_at(data, candidate.start())
                except Damaged:
                    continue
                yield at, candidate.start(), [], str(damage)
                at = candidate.start()
                break
            else:
                yield at, len(data), [], str(damage)
                return
        yield at, end, found, None
        at = end


def _bare(uri: str | None) -> str | None:
    return uri.strip("<>") if uri else None


def _row(archive: str, start: int, end: int, record: Record, payloads: bool) -> tuple:
    carried = record.payload()
    told = (record.header("WARC-Payload-Digest") or "").removeprefix("sha1:").upper() or None
    digest = told if carried is None else base32_sha1(carried)
    own, target = _bare(record.header("WARC-Record-ID")), _bare(record.header("WARC-Target-URI"))
    refers = _bare(record.header("WARC-Refers-To"))
    kind = record.header("WARC-Type")
    target = None if target == own else target
    kept = carried if payloads else None
    return archive, start, end - start, None, kind, own, target, refers, digest, record.payload_bytes(), kept


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), _TYPES)], _FIELDS)


def write_archives(
    pages: DataFrame, folder: str, least_bytes: int = 0, date: str = "1970-01-01T00:00:00Z", level: int = 6
) -> None:
    """Write a record for each row of ``pages (page_id, url, html, ...)``.

    The payload is ``html`` in UTF-8, NULL an empty one. Of pages with equal payloads of at
    least ``least_bytes`` bytes the one with the smallest page_id is a response (NULL last; of
    rows that repeat that id the one with the smallest URL, NULL first, and one of those that
    repeat this too); the others are revisits of it, without the payload. All other pages
    are responses. Columns beside the three are not written; an empty table gives a folder
    without records.

    Digests find the repeated payloads; pages whose payload occurs once are written where they
    are read (unless there are so many repeated payloads that these can't be broadcast), and
    of a repeated one only the response's copy is moved.
    """
    rows = pages.select(
        F.col("page_id").cast("long").alias("page_id"),
        F.col("url").cast("string").alias("url"),
        F.coalesce(F.col("html").cast("string"), F.lit("")).alias("html"),
    )
    keyed = rows.withColumns({"digest": F.sha1(F.col("html").cast("binary")), "size": F.octet_length("html").cast("long")})
    narrow = keyed.select("page_id", "url", "digest", "size")
    first = F.struct(F.col("page_id").isNull().alias("no_id"), "page_id", "url")
    repeated = (
        narrow.where(F.col("size") >= least_bytes)
        .groupBy("digest")
        .agg(F.min(first).alias("first"), F.count("*").alias("pages"))
        .where("pages > 1")
        .select("digest", F.col("first.page_id").alias("first_id"), F.col("first.url").alias("first_url"))
    )
    repeated, repeated_path = stage_at(repeated, "warc-repeated")
    is_first = F.col("page_id").eqNullSafe(F.col("first_id")) & F.col("url").eqNullSafe(F.col("first_url"))
    again = (
        narrow.join(repeated, "digest")
        .groupBy("page_id", "url", "digest", "size", "first_id", "first_url")
        .agg(F.count("*").alias("copies"))
        .select("page_id", "url", "digest", "size", "first_id", (F.col("copies") - is_first.cast("int")).alias("copies"))
        .where("copies > 0")
    )
    again, again_path = stage_at(again, "warc-revisits")
    revisits = replicate_rows(again, "copies").select(
        "page_id", "url", F.lit(None).cast("string").alias("html"), "digest", "size", "first_id"
    )
    no_one = F.lit(None).cast("long").alias("first_id")
    once = keyed.join(repeated, "digest", "left_anti").select("page_id", "url", "html", "digest", "size", no_one)
    each = [F.first(c).alias(c) for c in ("page_id", "url", "html", "size")]
    firsts = keyed.join(repeated, "digest").where(is_first).groupBy("digest").agg(*each)
    records = once.union(firsts.select("page_id", "url", "html", "digest", "size", no_one)).union(revisits)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        members, held = [], 0
        for batch in batches:
            for page_id, url, html, hex_digest, size, first_id in zip(*(c for c in batch.columns)):
                digest = base64.b32encode(bytes.fromhex(hex_digest.as_py())).decode()
                payload = html.as_buffer().to_pybytes() if html.is_valid else None
                refers = page_urn(first_id.as_py(), digest)
                record = page_record(page_id.as_py(), url.as_py(), payload, size.as_py(), digest, refers, date)
                members.append(gzipped(record, level))
                held += len(members[-1])
                if held >= CHUNK_BYTES:
                    yield pa.RecordBatch.from_arrays([pa.array([b"".join(members)], pa.binary())], ["members"])
                    members, held = [], 0
        if members:
            yield pa.RecordBatch.from_arrays([pa.array([b"".join(members)], pa.binary())], ["members"])

    chunks = records.mapInArrow(run, "members binary")
    writer = chunks.select(F.col("members").cast("string")).write.option("encoding", "ISO-8859-1")
    writer = writer.option("lineSep", SEPARATOR.decode("latin-1")).option("maxRecordsPerFile", CHUNKS_PER_ARCHIVE)
    writer.text(folder)
    for path in (repeated_path, again_path):
        discard(pages.sparkSession, path)


def read_archives(spark: SparkSession, folder: str, payloads: bool = True) -> DataFrame:
    """All records of the archives in ``folder``, and a row with ``reason`` for each gap.

    ``archive, offset, length`` name the bytes: of a gap, of a plain record, or of the member
    that holds the record. ``payload_digest`` is the SHA-1 of the payload, of a revisit the
    one that it names, in base 32; ``payload_bytes`` likewise. An id that is missing, or a
    target that is the record's own id, is NULL; so is ``payload`` for revisits, or without
    ``payloads``. An archive is read whole by one task, so it must be below 2 GB.
    """
    archives = spark.read.format("binaryFile").load(folder).select("path", "content")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, content in zip(batch.column("path"), batch.column("content")):
                rows, held, name = [], 0, path.as_py()
                for start, end, found, reason in salvage(content.as_buffer().to_pybytes()):
                    if reason:
                        rows.append((name, start, end - start, reason, *[None] * 7))
                    rows += [_row(name, start, end, record, payloads) for record in found]
                    held += end - start
                    if held >= CHUNK_BYTES:
                        yield _batch(rows)
                        rows, held = [], 0
                if rows:
                    yield _batch(rows)

    return archives.mapInArrow(run, SCHEMA)


def log_gaps(read: DataFrame, path: str) -> DataFrame:
    """The records of ``read_archives``; its gaps go to the Parquet table ``path``, by archive
    and offset. ``read`` should be a stored table."""
    gaps = read.where(F.col("reason").isNotNull()).select("archive", "offset", "length", "reason")
    gaps.sort("archive", "offset").write.mode("append").parquet(path)
    return read.where(F.col("reason").isNull()).drop("reason")
