"""WARC archives: a writer, and a reader that gets on past damage.

The reader checks each record (version line, header, length, end, digest; in compressed
archives also the member's checksum). Where a check fails it searches byte by byte for
the next place at which a whole record or member can be read, goes on from there, and
logs the bytes in between as a gap. The content of a member is searched in the same way,
also what a broken member yields up to the place where it cannot be inflated further; a
record in there is trusted as one in a plain archive is. No whole record before or
behind a damaged place is lost, but for those that only lost bytes of their own member
would inflate.
"""

from __future__ import annotations

import base64
import hashlib
import re
import zlib
from dataclasses import dataclass
from typing import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from riskflow.llm.common import Batches, map_rows, stored
from riskflow.storage import scratch_dir

# Fixed values of the formats.
VERSION = "WARC/1.1"
END = "\r\n\r\n"
HTTP_HEAD = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"
MANDATORY = ("warc-type", "warc-record-id", "content-length")
MAGIC = b"\x1f\x8b\x08"
EMPTY_MEMBER = bytes.fromhex("1f8b080000000000000303000000000000000000")
BASE32, DIGITS32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567", "0123456789ABCDEFGHIJKLMNOPQRSTUV"

VERSION_LINE = re.compile(rb"WARC/\d\.\d\r\n")
START = re.compile(rb"WARC/\d\.\d\r\n|\x1f\x8b\x08")
FEED = 1 << 16
DATE = "2000-01-01T00:00:00Z"
RECORDS_PER_FILE = 4096
FILE_BYTES = 128 << 20  # of plain records, unless a single one is larger
HEADER_BYTES = 1024  # more than a record has besides payload and address


def digest_of(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def sha1_base32(payload: Column) -> Column:
    """Upper-case base32 of the SHA-1: five bytes, eight characters, at a time."""
    hexed = F.sha1(payload)
    parts = [F.lpad(F.conv(F.substring(hexed, 10 * i + 1, 10), 16, 32), 8, "0") for i in range(4)]
    return F.translate(F.concat(*parts), DIGITS32, BASE32)


def records(pages: DataFrame, least_bytes: int = 0, key: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """Columns page_id, url, payload, payload_bytes, digest, refers_to, a row per page.

    Of pages with equal payload the one with the largest id holds it and the others refer
    to it; payloads of fewer than `least_bytes` are held by every page. A NULL payload is
    an empty one. A page without id refers to the holder like any other; if no page with
    the payload has an id, all of them hold it. Payloads are compared by SHA-1 and length;
    holders are found with one row per payload and task moved, and joined to that row.
    """
    payload = F.coalesce(F.col(html), F.lit(""))
    plain = pages.select(
        F.col(key).alias("page_id"), F.col(url).alias("url"), payload.alias("payload"),
        F.octet_length(payload).cast("long").alias("payload_bytes"), sha1_base32(payload.cast("binary")).alias("digest"),
    )
    shared = (
        plain.where(F.col("payload_bytes") >= least_bytes)
        .groupBy("digest", "payload_bytes")
        .agg(F.max("page_id").alias("holder"), F.count(F.lit(1)).alias("n"))
        .where("n > 1")
        .drop("n")
    )
    # a table of its own: a join right above an aggregate could not be split where it is skewed
    shared = stored(shared, "payload_holders")
    refers = F.when(F.col("page_id").isNull() | (F.col("page_id") < F.col("holder")), F.col("holder"))
    return plain.join(shared, ["digest", "payload_bytes"], "left").select(*plain.columns, refers.alias("refers_to"))


def record_text(date: str = DATE) -> Column:
    """A whole record but for its end, from the columns of `records`."""
    line = lambda name, value: F.concat(F.lit(f"{name}: "), value, F.lit("\r\n"))
    maybe = lambda column: F.coalesce(column, F.lit(""))
    name = lambda column: F.concat(F.lit("<urn:page:"), F.coalesce(column.cast("string"), F.lit("none")), F.lit(">"))
    held = F.col("refers_to").isNull()
    block = F.concat(F.lit(HTTP_HEAD), F.when(held, F.col("payload")).otherwise(""))
    address = F.replace(F.replace("url", F.lit("\r"), F.lit("%0D")), F.lit("\n"), F.lit("%0A"))
    return F.concat(
        F.lit(f"{VERSION}\r\n"),
        line("WARC-Type", F.when(held, F.lit("response")).otherwise("revisit")),
        line("WARC-Record-ID", name(F.col("page_id"))),
        line("WARC-Date", F.lit(date)),
        maybe(line("WARC-Target-URI", address)),
        maybe(F.when(~held, line("WARC-Refers-To", name(F.col("refers_to"))))),
        line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("digest"))),
        line("X-Payload-Length", F.col("payload_bytes").cast("string")),
        line("Content-Type", F.lit("application/http; msgtype=response")),
        line("Content-Length", F.octet_length(block).cast("string")),
        F.lit("\r\n"),
        block,
    )


def _members(batches: Batches) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        members = []
        for record in batch.column(0):
            packer = zlib.compressobj(wbits=31)
            members.append(packer.compress(record.as_py().encode() + END.encode()) + packer.flush())
        yield pa.RecordBatch.from_arrays([pa.array(members, pa.binary())], ["member"])


def size_class(records_per_file: int, file_bytes: int) -> Column:
    """0 for records of which `records_per_file` fit into a file, k if a 2**k-th of that
    number does. From the columns of `records`; sizes are upper bounds."""
    most = F.col("payload_bytes") + 3 * F.coalesce(F.octet_length("url"), F.lit(0)) + HEADER_BYTES
    return F.greatest(F.ceil(F.log2(most * records_per_file / file_bytes)), F.lit(0)).cast("int")


def write(
    pages: DataFrame,
    path: str,
    compress: bool = False,
    records_per_file: int = RECORDS_PER_FILE,
    file_bytes: int = FILE_BYTES,
    **names: object,
) -> None:
    """Archives of all pages in a folder, on any file system that Spark writes to.

    A file has at most `file_bytes` before compression, or one record: each class of
    record sizes within a factor of two has files, and a pass, of its own, with as many
    records to a file as are sure to fit. Lines of Spark's text files are records here: what ends a line is what ends a record,
    or, compressed, an empty member after the record's own, which gzip reads as nothing.
    """
    sized = records(pages, **names).withColumn("size_class", size_class(records_per_file, file_bytes))
    url, html = names.get("url", "url"), names.get("html", "html")
    bounds = pages.select(F.col(url).alias("url"), F.coalesce(F.octet_length(html), F.lit(0)).cast("long").alias("payload_bytes"))
    classes = bounds.select(size_class(records_per_file, file_bytes).alias("k")).distinct().collect()
    for i, k in enumerate(sorted(r["k"] for r in classes) or [0]):
        of_class = sized.where(F.col("size_class") == k) if len(classes) > 1 else sized
        _write(of_class.select(record_text().alias("record")), path, compress, max(1, records_per_file >> k), "append" if i else "error")


def _write(texts: DataFrame, path: str, compress: bool, records_per_file: int, mode: str) -> None:
    out = texts.write.mode(mode).option("maxRecordsPerFile", records_per_file)
    if not compress:
        out.option("lineSep", END).text(path)
        return
    packed = map_rows(texts, _members, "member binary").select(F.col("member").cast("string"))
    packed.write.mode(mode).option("maxRecordsPerFile", records_per_file).option("encoding", "ISO-8859-1").option(
        "lineSep", EMPTY_MEMBER.decode("latin-1")
    ).text(path)


class Damaged(Exception):
    """A check failed; the bytes up to `end`, if known, hold no record."""

    def __init__(self, reason: str, end: int | None = None):
        super().__init__(reason)
        self.end = end


@dataclass(frozen=True)
class Record:
    """Offset and length are those of the member, if the record is in one, and the inner
    ones are places in the member's content."""

    offset: int
    length: int
    headers: dict[str, str]
    payload: bytes
    inner_offset: int | None = None
    inner_length: int | None = None


@dataclass(frozen=True)
class InnerGap:
    """Bytes of a member's content that are in no record, while others of it are."""

    offset: int
    length: int
    inner_offset: int
    inner_length: int


def parse_record(raw: bytes, at: int) -> tuple[dict[str, str], bytes, int]:
    """Headers, payload and end of the record at a place, all checks done."""
    version = VERSION_LINE.match(raw, at)
    if not version:
        raise Damaged("version line")
    stop = raw.find(b"\r\n\r\n", version.end() - 2)
    if stop < 0:
        raise Damaged("header")
    headers = {}
    for line in raw[version.end() : stop].split(b"\r\n"):
        name, colon, value = line.partition(b":")
        if not colon:
            raise Damaged("header line")
        headers[name.decode("latin-1").strip().lower()] = value.decode("utf-8", "replace").strip()
    if any(name not in headers for name in MANDATORY):
        raise Damaged("header lacks a field")
    if not headers.get("content-length", "").isascii() or not headers.get("content-length", "").isdigit():
        raise Damaged("length")
    first = stop + 4
    end = first + int(headers["content-length"])
    if raw[end : end + 4] != b"\r\n\r\n":
        raise Damaged("end")
    block = raw[first:end]
    payload = block.partition(b"\r\n\r\n")[2] if headers.get("content-type", "").startswith("application/http") else block
    digest = headers.get("warc-payload-digest", "")
    if headers.get("warc-type") != "revisit" and digest.startswith("sha1:") and digest[5:] != digest_of(payload):
        raise Damaged("digest")
    return headers, payload, end + 4


def parse_member(raw: bytes, at: int) -> tuple[bytes, int]:
    """Content and end of the gzip member at a place; its checksum is right."""
    reader, out, fed = zlib.decompressobj(31), [], at
    try:
        while not reader.eof:
            part = raw[fed : fed + FEED]
            if not part:
                raise Damaged("member cut off")
            out.append(reader.decompress(part))
            fed += len(part)
    except zlib.error as error:
        raise Damaged(str(error)) from error
    return b"".join(out), fed - len(reader.unused_data)


def bytewise(raw: bytes, at: int, fed: int, most: int | None = None) -> tuple[bytes, int]:
    """What the broken member at a place yields, and how far it was read.

    Up to `fed` it is known to inflate; from there on one byte at a time is given to zlib,
    which keeps back what it makes of input that it refuses. Stops at `most` bytes.
    """
    reader = zlib.decompressobj(31)
    out = [reader.decompress(raw[at:fed])]
    size = len(out[0])
    try:
        while fed < len(raw) and not reader.eof and (most is None or size < most):
            out.append(reader.decompress(raw[fed : fed + 1]))
            size += len(out[-1])
            fed += 1
    except zlib.error:
        pass
    return b"".join(out), fed


def broken_member(raw: bytes, at: int) -> bytes:
    """The content of a member that is cut off or fails a check, as far as it inflates."""
    reader, fed = zlib.decompressobj(31), at
    try:
        while fed < len(raw):
            reader.decompress(raw[fed : fed + FEED])
            fed += FEED
    except zlib.error:
        pass
    return bytewise(raw, at, min(fed, len(raw)))[0]


def place_of(raw: bytes, at: int, size: int) -> int:
    """Where so many bytes of the content of the member at a place have been read."""
    reader, fed, made = zlib.decompressobj(31), at, 0
    try:
        while made < size and fed < len(raw):
            made += len(reader.decompress(raw[fed : fed + FEED]))
            fed += FEED
        fed -= FEED
    except zlib.error:
        pass
    return bytewise(raw, at, fed, size)[1]


def read_content(content: bytes) -> Iterator[tuple[int, int, dict[str, str] | None, bytes | None]]:
    """Start and end of each record, with headers and payload, and of each gap, without."""
    at, gap = 0, None
    while at < len(content):
        try:
            headers, payload, end = parse_record(content, at)
        except Damaged:
            gap = at if gap is None else gap
            start = VERSION_LINE.search(content, at + 1)
            at = start.start() if start else len(content)
            continue
        if gap is not None:
            yield gap, at, None, None
            gap = None
        yield at, end, headers, payload
        at = end
    if gap is not None:
        yield gap, len(content), None, None


def read_at(raw: bytes, at: int) -> tuple[list[Record | InnerGap], int]:
    """The record, or the member with its records and gaps, at a place, and where it ends;
    a broken member ends with its last whole record."""
    if raw[at : at + 3] != MAGIC:
        headers, payload, end = parse_record(raw, at)
        return [Record(at, end - at, headers, payload)], end
    try:
        content, end = parse_member(raw, at)
    except Damaged:
        content, end = broken_member(raw, at), None
    parts = list(read_content(content))
    if end is None:
        if parts and parts[-1][2] is None:  # is in the gap of the bytes behind
            parts.pop()
        if not parts:
            raise Damaged("no whole record in a broken member")
        end = place_of(raw, at, parts[-1][1])
    elif parts and all(headers is None for _, _, headers, _ in parts):
        raise Damaged("no record in a member", end)
    found: list[Record | InnerGap] = []
    for start, stop, headers, payload in parts:
        if headers is None:
            found.append(InnerGap(at, end - at, start, stop - start))
        else:
            found.append(Record(at, end - at, headers, payload, start, stop - start))
    return found, end


def salvage(raw: bytes) -> Iterator[Record | InnerGap | tuple[int, int]]:
    """Records in order, (start, end) of each gap of bytes that are in none, and the gaps
    inside of members that hold records too."""
    at, gap = 0, None
    while at < len(raw):
        try:
            found, end = read_at(raw, at)
        except Damaged as damage:
            gap = at if gap is None else gap
            start = START.search(raw, at + 1) if damage.end is None else None
            at = start.start() if start else damage.end or len(raw)
            continue
        if gap is not None:
            yield gap, at
            gap = None
        yield from found
        at = end
    if gap is not None:
        yield gap, len(raw)


LOG = {
    "path": "string", "kind": "string", "offset": "long", "length": "long", "inner_offset": "long", "inner_length": "long", "record_id": "string", "record_type": "string",
    "refers_to": "string", "target_uri": "string", "payload_bytes": "long", "payload_digest": "string", "payload": "binary",
}


def _read(with_payload: bool):
    def row(path: str, item: Record | InnerGap | tuple[int, int]) -> tuple:
        if isinstance(item, tuple):
            return (path, "gap", item[0], item[1] - item[0], *[None] * 9)
        place = item.offset, item.length, item.inner_offset, item.inner_length
        if isinstance(item, InnerGap):
            return (path, "gap", *place, *[None] * 7)
        h = item.headers
        revisit = h.get("warc-type") == "revisit"
        size, digest = len(item.payload), None
        if revisit:  # the payload is elsewhere; the header tells of it
            told = h.get("x-payload-length", "")
            size = int(told) if told.isascii() and told.isdigit() else None
            digest = h.get("warc-payload-digest", "").removeprefix("sha1:") or None
        else:
            digest = digest_of(item.payload)
        payload = item.payload if with_payload and not revisit else None
        return path, "record", *place, h.get("warc-record-id"), h.get("warc-type"), h.get("warc-refers-to"), h.get("warc-target-uri"), size, digest, payload

    def rows(batches: Batches) -> Iterator[pa.RecordBatch]:
        kinds = [pa.string(), pa.string(), *[pa.int64()] * 4, *[pa.string()] * 4, pa.int64(), pa.string(), pa.binary()]

        def batch_of(lines: list[tuple]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*lines), kinds)], list(LOG))

        for batch in batches:
            for path, content in zip(batch.column(0), batch.column(1)):
                lines, held = [], 0
                for item in salvage(content.as_py()):
                    lines.append(row(path.as_py(), item))
                    held += len(lines[-1][-1] or b"") + 500
                    if held > 8 << 20:
                        yield batch_of(lines)
                        lines, held = [], 0
                if lines:
                    yield batch_of(lines)

    return rows


def read(spark: SparkSession, path: str, with_payload: bool = False) -> DataFrame:
    """A row per record and per gap (column kind) of all archives in a folder.

    In members, offset and length are the member's; inner_offset and inner_length are
    places in its content.

    An archive is read whole by one task, which needs about four times its size; the
    writer here makes small ones, many to a task. Archives of 2 GB and more, from
    elsewhere, fail.
    """
    files = spark.read.format("binaryFile").load(path).select("path", "content")
    return map_rows(files, _read(with_payload), ", ".join(f"{name} {kind}" for name, kind in LOG.items()))


def page_id(name: Column) -> Column:
    return F.regexp_extract(name, r"^<urn:page:(-?\d+)>$", 1).try_cast("long")


def whole(found: DataFrame) -> DataFrame:
    """The records that were read; a gap, which is a loss, fails the job and names its place."""
    message = F.concat(F.lit("damaged archive: "), F.col("path"), F.lit(" at byte "), F.col("offset").cast("string"))
    return found.where(F.when(F.col("kind") == "record", F.lit(True)).otherwise(F.raise_error(message).cast("boolean")))


def round_trip(pages: DataFrame, least_bytes: int = 0, compress: bool = False) -> DataFrame:
    """Columns page_id, payload_bytes, payload_digest, record_type, refers_to as read
    back from archives that the pages were written to, a row per page.

    A place of the archives that cannot be read fails the job, so no page goes missing.
    NULL html is empty. Of pages with one payload that with the largest id holds it, and
    rows that repeat one another are pages of their own. A very large page has an archive
    to itself. An empty table gives an empty one. Other columns are ignored, whatever
    their names.
    """
    path = scratch_dir(pages.sparkSession, "warc")
    write(pages, path, compress, least_bytes=least_bytes)
    found = whole(read(pages.sparkSession, path))
    return found.select(page_id(F.col("record_id")).alias("page_id"), "payload_bytes", "payload_digest", "record_type", page_id(F.col("refers_to")).alias("refers_to"))
