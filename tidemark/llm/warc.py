"""WARC archives: writing with revisits, and reading what is left of damaged ones.

An archive is a file of records, each its own gzip member or, uncompressed, one after another. The reader
checks each record in full: the member's checksum, the version line, the headers, the length, the end and
the digest of the payload. Where a check fails it looks for the next place at which a record can begin, a
member's magic number or a version line, and tries again there; the bytes passed over are logged as a gap.

Records of any writer are read. This writer's own carry a page's id and the payload's length in headers
of their own, which are checked where they are present, as digests are.
"""

from __future__ import annotations

import re
import zlib
from base64 import b32encode
from collections.abc import Iterator
from hashlib import sha1, sha256
from typing import BinaryIO, NamedTuple
from uuid import NAMESPACE_URL, uuid5

import pandas as pd
from pyarrow import fs
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.tables import saved
from tidemark.storage import scratch_path

_VERSION = b"WARC/1.1\r\n"
_MAGIC = b"\x1f\x8b\x08"
_START = re.compile(rb"WARC/1\.[01]\r\n")
_CHUNK = 1 << 16
_HEAD = 1 << 16  # headers longer than this are no headers
_DATE = "2024-01-01T00:00:00Z"
_READ = 1 << 20  # bytes asked of the file system at a time
_NAME = re.compile(rb"[!-9;-~]+")
RECORDS = (
    "archive string, offset long, length long, type string, id string, refers_to string, payload_bytes long, "
    "payload_digest string, target string, record_id string, payload binary"
)
GAPS = "archive string, start long, end long, reason string"


class Record(NamedTuple):
    offset: int
    length: int
    type: str
    id: str | None  # of the page, in this writer's records
    refers_to: str | None  # a page's id in this writer's records, else a record's
    payload_bytes: int
    payload_digest: str  # SHA-256 of the payload; of a revisit what its header says
    target: str | None
    record_id: str | None
    payload: bytes | None = None  # if asked for


class Gap(NamedTuple):
    start: int
    end: int
    reason: str


class Damaged(ValueError):
    """A record fails a check."""


def record_id(page: object) -> str:
    return f"<{uuid5(NAMESPACE_URL, f'page:{page}').urn}>"


def record_bytes(
    page: object, target: str | None, payload: bytes, digest: str, refers_to: object = None, compress: bool = True
) -> bytes:
    """One record. A revisit (`refers_to` is given) carries the payload's digest and length, not the payload."""
    revisit = refers_to is not None
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if revisit else http + payload
    head = [
        ("WARC-Type", "revisit" if revisit else "response"),
        ("WARC-Record-ID", record_id(page)),
        ("WARC-Date", _DATE),
        ("WARC-Target-URI", re.sub(r"[\x00-\x20\x7f]", lambda c: f"%{ord(c[0]):02X}", target or "")),
        ("WARC-Payload-Digest", f"sha256:{digest}"),
        ("Page-ID", str(page)) if page is not None else ("Page-None", "1"),
        ("Payload-Length", str(len(payload))),
        ("Content-Type", "application/http;msgtype=response"),
        ("Content-Length", str(len(block))),
    ]
    if revisit:
        head.insert(2, ("WARC-Refers-To", record_id(refers_to)))
        head.insert(3, ("Refers-To-Page", str(refers_to)))
        head.insert(4, ("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"))
    lines = "".join(f"{name}: {value}\r\n" for name, value in head).encode()
    data = _VERSION + lines + b"\r\n" + block + b"\r\n\r\n"
    if not compress:
        return data
    packer = zlib.compressobj(6, wbits=31)
    return packer.compress(data) + packer.flush()


# --- reading ------------------------------------------------------------------


class _Window:
    """A file that can be read anywhere, with a bounded piece of it in memory."""

    def __init__(self, source: BinaryIO) -> None:
        self.source, self.start, self.data = source, 0, b""
        self.size = source.seek(0, 2)

    def piece(self, offset: int, least: int = 1) -> bytes:
        """At least `least` bytes from `offset` on; fewer only at the end."""
        at = offset - self.start
        if at < 0 or len(self.data) - at < min(least, self.size - offset):
            self.source.seek(offset)
            self.data, self.start, at = self.source.read(max(least, _READ)), offset, 0
        return self.data[at : at + max(least, _CHUNK)]


class _Parser:
    """Checks one record from its uncompressed bytes, given piece by piece; keeps the payload only if asked to."""

    def __init__(self, payload: bool = False) -> None:
        self.head, self.headers = bytearray(), None
        self.left = self.tail = 0
        self.http: bytearray | None = None  # of an HTTP message, until its headers end
        self.kept = bytearray() if payload else None
        self.block, self.payload, self.size = None, sha256(), 0
        self.coded = self.done = False

    def feed(self, data: bytes) -> bytes:
        """Takes what belongs to the record and gives back the rest."""
        if self.headers is None:
            self.head += data
            end = self.head.find(b"\r\n\r\n")
            if not _VERSION.startswith(bytes(self.head[:5])) or (len(self.head) >= 10 and not _START.match(self.head)):
                raise Damaged("no version line")
            if end < 0:
                if len(self.head) > _HEAD:
                    raise Damaged("no end of headers")
                return b""
            data, head = bytes(self.head[end + 4 :]), bytes(self.head[:end])
            self._open(head)
        block, data = data[: self.left], data[self.left :]
        self.left -= len(block)
        self._take(block)
        if not self.left and data and self.tail < 4:
            end = data[: 4 - self.tail]
            if end != b"\r\n\r\n"[self.tail : self.tail + len(end)]:
                raise Damaged("no end of record")
            self.tail += len(end)
            data = data[len(end) :]
        self.done = not self.left and self.tail == 4
        return data if self.done else b""

    def _open(self, head: bytes) -> None:
        headers, last = {}, None
        for line in head.split(b"\r\n")[1:]:
            name, colon, value = line.partition(b":")
            if line[:1] in (b" ", b"\t") and last:  # a value may go on in the next line
                headers[last] += f" {line.strip().decode('utf-8', 'replace')}"
                continue
            if not colon or not _NAME.fullmatch(name) or b"\0" in value:
                raise Damaged("a header without a name")
            last = name.lower().decode()
            headers[last] = value.strip().decode("utf-8", "replace")
        try:
            self.left, self.type = int(headers["content-length"]), headers["warc-type"]
            self.expected = int(headers["payload-length"]) if "payload-length" in headers else None
        except (KeyError, ValueError):
            raise Damaged("a header is missing or malformed") from None
        self.id, self.record_id = headers.get("page-id"), headers.get("warc-record-id")
        own = self.id is not None or "page-none" in headers
        if self.left < 0 or not self.type or own != (self.expected is not None):
            raise Damaged("a header is missing or malformed")
        if own and (self.record_id != record_id(self.id) or self.type not in ("response", "revisit")):
            raise Damaged("a header is missing or malformed")
        if own and (self.type == "revisit") != ("refers-to-page" in headers):
            raise Damaged("a header is missing or malformed")
        if headers.get("content-type", "").lower().startswith("application/http"):
            self.http = bytearray()
        if headers.get("warc-block-digest", "").startswith("sha1:"):
            self.block = sha1()
        self.short = sha1() if headers.get("warc-payload-digest", "").startswith("sha1:") else None
        self.headers = headers

    def _take(self, data: bytes) -> None:
        if self.block is not None:
            self.block.update(data)
        if self.http is not None:
            self.http += data
            end = self.http.find(b"\r\n\r\n")
            if end < 0:
                if self.left and len(self.http) <= _HEAD:
                    return
                end = -4  # no HTTP headers after all
            data, head = bytes(self.http[end + 4 :]), bytes(self.http[: max(end, 0)])
            self.http, self.coded = None, b"\r\ntransfer-encoding:" in head.lower()
        self.payload.update(data)
        self.size += len(data)
        if self.short is not None:
            self.short.update(data)
        if self.kept is not None:
            self.kept += data

    def record(self, offset: int, length: int) -> Record:
        if not self.done:
            raise Damaged("the record is cut off")
        found = self.headers.get
        said = found("warc-payload-digest", "").removeprefix("sha256:")
        if self.block is not None and said_sha1(self.block) != found("warc-block-digest"):
            raise Damaged("the block differs from its digest")
        digest = self.payload.hexdigest()
        if self.type == "revisit":
            if self.expected is not None and self.size:
                raise Damaged("a revisit with a payload")
            digest = said
        elif self.expected is not None and (self.size, digest) != (self.expected, said):
            raise Damaged("the payload differs from its digest")
        elif self.short is not None and not self.coded and said_sha1(self.short) != said:
            raise Damaged("the payload differs from its digest")
        elif re.fullmatch("[0-9a-f]{64}", said) and not self.coded and said != digest:
            raise Damaged("the payload differs from its digest")
        size = self.size if self.expected is None else self.expected
        refers_to = found("refers-to-page", found("warc-refers-to"))
        kept = None if self.kept is None else bytes(self.kept)
        return Record(offset, length, self.type, self.id, refers_to, size, digest, found("warc-target-uri"), self.record_id, kept)


def said_sha1(digest) -> str:
    """A SHA-1 as headers have it."""
    return f"sha1:{b32encode(digest.digest()).decode()}"


def _member(window: _Window, offset: int, payload: bool) -> Record:
    """The record of the gzip member at `offset`."""
    parser, unpack, at = _Parser(payload), zlib.decompressobj(wbits=31), offset
    try:
        while not unpack.eof:
            piece = window.piece(at)
            if not piece:
                raise Damaged("the member is cut off")
            at += len(piece)
            data = unpack.decompress(piece, _CHUNK)
            while True:
                if data and parser.feed(data):
                    raise Damaged("more than a record in a member")
                if unpack.eof or not unpack.unconsumed_tail:
                    break
                data = unpack.decompress(unpack.unconsumed_tail, _CHUNK)
    except zlib.error:
        raise Damaged("the member fails its checks") from None
    return parser.record(offset, at - len(unpack.unused_data) - offset)


def _plain(window: _Window, offset: int, payload: bool) -> Record:
    """The record at `offset` of an uncompressed archive. Of a long one the end is looked at first: a false head
    mostly shows there, and costs no more than its headers."""
    parser, at, seen = _Parser(payload), offset, False
    while not parser.done:
        piece = window.piece(at)
        if not piece:
            raise Damaged("the record is cut off")
        at += len(piece) - len(parser.feed(piece))
        if parser.headers is not None and not seen:
            seen = True
            if parser.left and window.piece(at + parser.left, 4)[:4] != b"\r\n\r\n":
                raise Damaged("no end of record")
    return parser.record(offset, at - offset)


def salvage(source: BinaryIO, *, payload: bool = False) -> Iterator[Record | Gap]:
    """The records of an archive and the gaps between them, in order. The source must be one that can be read
    anywhere; a bounded piece of it is in memory, and a record's payload if asked for."""
    window, offset = _Window(source), 0
    gap, reason = None, ""
    while offset < window.size:
        first = window.piece(offset, 10)
        try:
            if first.startswith(_MAGIC):
                record = _member(window, offset, payload)
            elif _START.match(first):
                record = _plain(window, offset, payload)
            else:
                raise Damaged("no record begins here")
        except Damaged as damage:
            if gap is None:
                gap, reason = offset, str(damage)
            offset = _next(window, offset + 1)
            continue
        if gap is not None:
            yield Gap(gap, offset, reason)
            gap = None
        yield record
        offset += record.length
    if gap is not None:
        yield Gap(gap, offset, reason)


def _next(window: _Window, offset: int) -> int:
    """Where from `offset` on a record can begin: a member's magic number or a version line; else the end."""
    while offset < window.size:
        data = window.piece(offset, 7)
        if places := [p for p in (data.find(_MAGIC), data.find(b"WARC/1.")) if p >= 0]:
            return offset + min(places)
        offset += max(1, len(data) - 6)  # a mark may go over the end
    return window.size


# --- tables -------------------------------------------------------------------


def with_revisits(pages: DataFrame, least: int = 100) -> DataFrame:
    """Adds `payload_bytes, payload_digest, refers_to` to `page_id, url, payload` (binary).

    Of equal payloads of `least` bytes or more, all but the least page refer to it. The owners of repeated
    payloads are found by an aggregate; no group is gathered. A null page comes after all others.
    """
    sized = pages.withColumns({"payload_bytes": F.octet_length("payload").cast("long"), "payload_digest": F.sha2("payload", 256)})
    large = sized.where(F.col("payload_bytes") >= least).groupBy("payload_digest")
    first = large.agg(F.min("page_id").alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1 and first is not null")
    joined = sized.join(first.drop("n"), "payload_digest", "left")
    refers = F.when((F.col("payload_bytes") >= least) & ~F.col("page_id").eqNullSafe(F.col("first")), F.col("first"))
    return joined.withColumn("refers_to", refers).drop("first")


def write_archives(pages: DataFrame, folder: str, *, compress: bool = True, roll_bytes: int = 1 << 25) -> DataFrame:
    """Writes a record per row of `with_revisits` into archives below `folder`, and returns `archive, bytes,
    records`, one row per archive.

    Tasks write through the folder's file system, each archive under a name of its own attempt, and report it
    when it is closed. The returned table is written once, so it names exactly the archives of the attempts
    that counted; what a lost or repeated attempt leaves is not in it and is never read.
    """
    suffix = ".warc.gz" if compress else ".warc"

    def write(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from uuid import uuid4

        system, path = fs.FileSystem.from_uri(folder)
        system.create_dir(path, recursive=True)
        attempt, part, out, size, count, done = uuid4().hex, 0, None, 0, 0, []
        for batch in batches:
            columns = (batch[c] for c in ("page_id", "url", "payload", "payload_digest", "refers_to"))
            for page, url, payload, digest, refers_to in zip(*columns):
                if out is None:
                    name = f"{attempt}-{part:05d}{suffix}"
                    out, size, count, part = system.open_output_stream(f"{path}/{name}", compression=None), 0, 0, part + 1
                data = record_bytes(page, url, payload, digest, refers_to, compress)
                out.write(data)
                size, count = size + len(data), count + 1
                if size >= roll_bytes:
                    out.close()
                    done.append((name, size, count))
                    out = None
        if out is not None:
            out.close()
            done.append((name, size, count))
        yield pd.DataFrame(done, columns=["archive", "bytes", "records"])

    text = pages.select("page_id", "url", "payload", "payload_digest", "refers_to")
    text = text.withColumns({c: F.col(c).cast("string") for c in ("page_id", "refers_to")})
    return saved(text.mapInPandas(write, "archive string, bytes long, records long"), "archives")


def read_archives(archives: DataFrame, folder: str, *, payload: bool = False) -> tuple[DataFrame, DataFrame]:
    """Records and gaps of the archives named in the column `archive`: two tables, RECORDS and GAPS.

    Every archive is read by one task piece by piece; archives are of bounded size, so they are spread over the
    cluster. Both tables come from one pass. Payloads are null unless asked for.
    """

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        system, path = fs.FileSystem.from_uri(folder)
        names = [*Record._fields, "start", "end", "reason"]
        for batch in batches:
            for archive in batch["archive"]:
                rows, held = [], 0
                with system.open_input_file(f"{path}/{archive}") as source:
                    for found in salvage(source, payload=payload):
                        record = isinstance(found, Record)
                        rows.append((*found, None, None, None) if record else (None,) * len(Record._fields) + found)
                        held += len(found.payload or b"") if record else 0
                        if len(rows) == 10_000 or held >= 1 << 25:
                            yield _frame(archive, rows, names)
                            rows, held = [], 0
                yield _frame(archive, rows, names)

    spread = archives.select("archive").repartition(max(1, min(archives.count(), 10_000)))
    both = saved(spread.mapInPandas(read, f"{RECORDS}, start long, end long, reason string"), "records")
    records = both.where("type is not null").drop("start", "end", "reason")
    return records, both.where("reason is not null").select("archive", "start", "end", "reason")


def _frame(archive: str, rows: list[tuple], names: list[str]) -> pd.DataFrame:
    frame = pd.DataFrame(rows, columns=names, dtype=object)
    frame.insert(0, "archive", archive)
    for name in ("offset", "length", "payload_bytes", "start", "end"):
        frame[name] = frame[name].astype("Int64")
    return frame


def archive_pages(
    pages: DataFrame,
    folder: str | None = None,
    *,
    page_id: str = "page_id",
    url: str = "url",
    html: str | Column = "html",
    compress: bool = True,
) -> tuple[DataFrame, DataFrame]:
    """Writes every page to archives in `folder` and reads them back: records and gaps.

    Records have the page's id in `id`, as text. A null html is an empty payload, a null url an empty target;
    a null page id is no id, and read as null. Rows with a repeated id are records of their own; a repeated
    payload of the same page stays a response. An empty table gives no archives. Other columns are ignored.
    """
    html = F.col(html) if isinstance(html, str) else html
    folder = folder or scratch_path(pages.sparkSession, "warc")
    if "://" not in folder and not folder.startswith("file:"):
        folder = f"file://{folder}"
    payload = F.coalesce(html.cast("string"), F.lit("")).cast("binary")
    rows = pages.select(
        F.col(page_id).alias("page_id"), F.col(url).cast("string").alias("url"), payload.alias("payload")
    )
    return read_archives(write_archives(with_revisits(rows), folder, compress=compress), folder)
