"""WARC archives: written by tasks, read by a Python data source.

Writing: pages of equal payload are found by SHA-256 in a narrow grouped
minimum; the page of the smallest id becomes a ``response`` record, the others
``revisit`` records without the payload.  Each task writes its rows to files
of its own, one gzip member per record with the member's length in the gzip
header (the ``sl`` skip-length field).  File names are those of one attempt;
the manifest that Spark commits says which attempts count, and its files are
listed in the folder (``_files``), which is what readers go by.

Reading (``spark.read.format("warc")``): one partition per file; comparisons
on record type and header columns are pushed down; per record only the first
bytes are inflated to parse the headers, and a record that the predicates
reject, or whose payload is not asked for, is skipped by its length without
inflating the rest.  A folder of another writer (without the list) is read
whole: compressed files without that field member by member, plain ``.warc``
files record by record.

Edge cases: a NULL html is an empty payload; pages that share id and payload
are alike responses or revisits; a NULL id is a revisit if an equal payload
has an id, else a response; control characters of a url are percent-escaped; empty
input gives no files and no rows; extra columns are not read.
"""
from __future__ import annotations

import base64
import hashlib
import struct
import uuid
import zlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from datetime import datetime, timezone

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import (
    DataSource,
    DataSourceReader,
    EqualNullSafe,
    EqualTo,
    Filter,
    GreaterThan,
    GreaterThanOrEqual,
    In,
    InputPartition,
    IsNotNull,
    IsNull,
    LessThan,
    LessThanOrEqual,
    Not,
    StringContains,
    StringEndsWith,
    StringStartsWith,
)

from tipscope.llm.shared_files import new_folder, open_store
from tipscope.llm.tables import Workspace, maybe_broadcast

PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
MAX_FILE_BYTES = 256 << 20
FILES = "_files"
_HEAD = 4096  # bytes inflated at a time while headers are parsed
SCHEMA = ("record_type string, page_id long, url string, record_id string, date string, refers_to long, "
          "payload_digest string, payload_bytes long, payload_ok boolean, payload binary")


# --- writing -----------------------------------------------------------------

def digest_of(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _record_id(page_id: int | None, digest: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'page/{page_id}/{digest}')}>"


def record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None, date: str) -> bytes:
    """One WARC record; a revisit if ``refers_to`` is given."""
    digest = digest_of(payload)
    block = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    head = [f"WARC-Type: {'response' if refers_to is None else 'revisit'}", f"WARC-Record-ID: {_record_id(page_id, digest)}",
            f"WARC-Date: {date}", f"WARC-Payload-Digest: sha1:{digest}", "Content-Type: application/http; msgtype=response"]
    if url is not None:
        head.append("WARC-Target-URI: " + "".join(c if c > " " and c != "\x7f" else f"%{ord(c):02X}" for c in url))
    if page_id is not None:
        head.append(f"X-Page-Id: {page_id}")
    if refers_to is None:
        block += payload
    else:
        head += [f"WARC-Refers-To: {_record_id(refers_to, digest)}", f"X-Refers-To-Page-Id: {refers_to}", f"WARC-Profile: {PROFILE}"]
    head.append(f"Content-Length: {len(block)}")
    return "\r\n".join(["WARC/1.1", *head, "", ""]).encode("utf-8", "surrogatepass") + block + b"\r\n\r\n"


def gzip_member(data: bytes) -> bytes:
    """One gzip member that names its own length in the ``sl`` extra field."""
    deflate = zlib.compressobj(4, zlib.DEFLATED, -15)
    body = deflate.compress(data) + deflate.flush()
    length = 10 + 2 + 12 + len(body) + 8
    if max(length, len(data)) >= 1 << 32:  # too long for the field
        header = b"\x1f\x8b\x08\x00" + bytes(4) + b"\x00\xff"
    else:
        header = b"\x1f\x8b\x08\x04" + bytes(4) + b"\x00\xff" + struct.pack("<H2sHII", 12, b"sl", 8, length, len(data))
    return header + body + struct.pack("<II", zlib.crc32(data), len(data) & 0xFFFFFFFF)


def _write(folder: str, date: str, max_bytes: int):
    """Map function: archive files of the task's rows; one manifest row per file."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        task, attempt = TaskContext.get(), uuid.uuid4().hex
        rows = ((p, u, h, r) for b in batches for p, u, h, r in zip(*(b[c].to_pylist() for c in ("page_id", "url", "html", "refers_to"))))
        row, number = next(rows, None), 0
        while row is not None:
            # a name of this attempt alone: files of lost or repeated attempts are in no manifest
            uri = f"{folder}/part-{task.partitionId():06d}-{number:04d}-{attempt}.warc.gz"
            store, path = open_store(uri)
            size, n = 0, 0
            with store.open_output_stream(path, compression=None) as out:
                while row is not None and size < max_bytes:
                    page_id, url, html, refers_to = row
                    member = gzip_member(record(page_id, url, (html or "").encode("utf-8", "surrogatepass"), refers_to, date))
                    out.write(member)
                    size, n, row = size + len(member), n + 1, next(rows, None)
            number += 1
            yield pa.RecordBatch.from_pylist([{"uri": uri, "records": n, "bytes": size}],
                                             schema=pa.schema([("uri", pa.string()), ("records", pa.int64()), ("bytes", pa.int64())]))

    return run


def write_archives(pages: DataFrame, min_revisit_bytes: int = 0, date: str | None = None,
                   max_file_bytes: int = MAX_FILE_BYTES) -> tuple[str, DataFrame]:
    """Write ``pages`` (page_id, url, html); returns the folder and the file manifest."""
    spark = pages.sparkSession
    ws = Workspace(spark, "warc")
    date = date or datetime.now(timezone.utc).strftime("%Y-%m-%dT%H:%M:%SZ")
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"),
                        F.col("html").cast("string").alias("html"))
    payload = F.coalesce("html", F.lit(""))
    signed = rows.withColumn("sha", F.unhex(F.sha2(payload, 256))).withColumn("n", F.octet_length(payload))
    narrow = ws.save(signed.where(F.col("n") >= min_revisit_bytes).select("page_id", "sha"), "signed")
    first = narrow.groupBy("sha").agg(F.min("page_id").alias("first"), F.count("*").alias("rows")).where("rows > 1").drop("rows")
    first = ws.save(first, "first")  # written, so that the join can split a payload of very many pages
    revisits = ws.save(narrow.join(first, "sha").where(F.col("first").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first"))).select(
        F.col("page_id").alias("revisit_id"), F.col("sha").alias("revisit_sha"), F.col("first").alias("refers_to")).distinct(), "revisits")
    side = maybe_broadcast(revisits, revisits.count(), 64)
    joined = signed.join(side, F.col("page_id").eqNullSafe(F.col("revisit_id")) & (F.col("sha") == F.col("revisit_sha")), "left")
    folder = new_folder(spark, "warc-files")
    manifest = ws.save(joined.select("page_id", "url", "html", "refers_to").mapInArrow(
        _write(folder, date, max_file_bytes), "uri string, records long, bytes long"), "manifest")
    ws.drop("signed", "first")
    store, path = open_store(f"{folder}/{FILES}")
    with store.open_output_stream(path, compression=None) as out:  # names the files of the committed manifest
        for row in manifest.select("uri").orderBy("uri").toLocalIterator():
            out.write(f"{row['uri'].rsplit('/', 1)[1]}\n".encode())
    return folder, manifest


# --- reading -----------------------------------------------------------------

@dataclass
class FilePartition(InputPartition):
    uri: str

    def __init__(self, uri: str) -> None:
        self.uri = uri


class _Source:
    """A file read forward by offset, in large blocks."""

    BLOCK = 1 << 20

    def __init__(self, file) -> None:
        self.file, self.start, self.held, self.size = file, 0, b"", file.size()

    def at(self, offset: int, length: int) -> bytes:
        if offset < self.start or offset + length > self.start + len(self.held):
            self.start = offset
            self.held = self.file.read_at(max(0, min(max(length, self.BLOCK), self.size - offset)), offset)
        return self.held[offset - self.start:offset - self.start + length]


class Member:
    """One gzip member: inflates only as far as it is asked to."""

    def __init__(self, source: _Source, offset: int) -> None:
        head = source.at(offset, 12)
        if head[:3] != b"\x1f\x8b\x08":
            raise ValueError(f"no gzip member at byte {offset}")
        self.source, self.offset, at, self.length = source, offset, offset + 10, None
        flags = head[3]
        if flags & 4:
            n = struct.unpack("<H", head[10:12])[0]
            extra, k = source.at(offset + 12, n), 0
            while k + 4 <= n:
                name, size = extra[k:k + 2], struct.unpack("<H", extra[k + 2:k + 4])[0]
                if name == b"sl" and size == 8:
                    self.length = struct.unpack("<I", extra[k + 4:k + 8])[0]
                k += 4 + size
            at += 2 + n
        for flag in (8, 16):  # file name, comment
            if flags & flag:
                while source.at(at, 1) != b"\0":
                    at += 1
                at += 1
        self.at = at + (2 if flags & 2 else 0)
        self.inflate, self.data = zlib.decompressobj(-15), bytearray()
        self.pending = b""

    @property
    def eof(self) -> bool:
        return self.inflate.eof

    def read(self, upto: int | None) -> bytearray:
        """The member's first ``upto`` bytes, or all of them."""
        while not self.inflate.eof and (upto is None or len(self.data) < upto):
            if not self.pending:
                self.pending = self.source.at(self.at, min(1 << 16, self.source.size - self.at))
                self.at += len(self.pending)
                if not self.pending:
                    raise ValueError(f"the record at byte {self.offset} is cut short")
            self.data += self.inflate.decompress(self.pending, 0 if upto is None else max(1, upto - len(self.data)))
            self.pending = b"" if self.inflate.eof else self.inflate.unconsumed_tail
        return self.data

    def next_offset(self, record_length: int) -> int:
        if self.length is not None:
            return self.offset + self.length
        self.read(None)
        return self.at - len(self.inflate.unused_data) - len(self.pending) + 8


class PlainRecord:
    """A record of a file that is not compressed: read only as far as it is asked to."""

    def __init__(self, source: _Source, offset: int) -> None:
        self.source, self.offset, self.data = source, offset, bytearray()

    @property
    def eof(self) -> bool:
        return self.offset + len(self.data) >= self.source.size

    def read(self, upto: int) -> bytearray:
        """The first ``upto`` bytes from the record's start, or what the file has."""
        while len(self.data) < upto and not self.eof:
            at = self.offset + len(self.data)
            self.data += self.source.at(at, min(upto - len(self.data), 1 << 16, self.source.size - at))
        return self.data

    def next_offset(self, record_length: int) -> int:
        return self.offset + record_length


def _fields(lines: list[bytes]) -> dict[str, str]:
    pairs = (line.decode("utf-8", "surrogatepass").partition(":") for line in lines)
    return {k.strip().lower(): v.strip() for k, _, v in pairs}


def _number(value: str | None) -> int | None:
    return int(value) if value is not None else None


_COLUMNS = ("record_type", "page_id", "url", "record_id", "date", "refers_to", "payload_digest", "payload_bytes")
_TESTS = {
    EqualTo: lambda a, b: a is not None and a == b, EqualNullSafe: lambda a, b: a == b,
    GreaterThan: lambda a, b: a is not None and a > b, GreaterThanOrEqual: lambda a, b: a is not None and a >= b,
    LessThan: lambda a, b: a is not None and a < b, LessThanOrEqual: lambda a, b: a is not None and a <= b,
    In: lambda a, b: a is not None and a in b,
    StringStartsWith: lambda a, b: a is not None and a.startswith(b), StringEndsWith: lambda a, b: a is not None and a.endswith(b),
    StringContains: lambda a, b: a is not None and b in a,
    IsNull: lambda a, _: a is None, IsNotNull: lambda a, _: a is not None,
}


class WarcReader(DataSourceReader):
    def __init__(self, options: dict[str, str]) -> None:
        self.folder = options["path"]
        #: "keep" returns payloads, "check" only compares their digest, "skip" never inflates them
        self.payload = options.get("payload", "keep")
        self.tests: list[tuple[str, str, object, bool]] = []

    def pushFilters(self, filters: list[Filter]) -> Iterable[Filter]:
        for f in filters:
            inner, wanted = (f.child, False) if isinstance(f, Not) else (f, True)
            column = getattr(inner, "attribute", (None,))
            value = getattr(inner, "value", None)
            simple = type(inner) in _TESTS and len(column) == 1 and column[0] in _COLUMNS
            if simple and (wanted or isinstance(inner, (IsNull, IsNotNull))):
                self.tests.append((column[0], type(inner).__name__, value, wanted))
            else:
                yield f

    def partitions(self) -> list[InputPartition]:
        from pyarrow import fs

        store, path = open_store(self.folder)
        prefix = self.folder.rstrip("/")
        if store.get_file_info(f"{path.rstrip('/')}/{FILES}").is_file:  # written here: the committed files only
            with store.open_input_stream(f"{path.rstrip('/')}/{FILES}", compression=None) as listed:
                return [FilePartition(f"{prefix}/{n}") for n in listed.read().decode().split()] or [FilePartition("")]
        found = store.get_file_info(fs.FileSelector(path, recursive=False, allow_not_found=True))
        names = sorted(f.base_name for f in found if f.is_file and f.base_name.endswith((".warc.gz", ".warc")))
        return [FilePartition(f"{prefix}/{n}") for n in names] or [FilePartition("")]

    def _wanted(self, row: dict) -> bool:
        by_name = {t.__name__: test for t, test in _TESTS.items()}
        return all(by_name[kind](row[column], value) is wanted for column, kind, value, wanted in self.tests)

    def read(self, partition: FilePartition) -> Iterator[tuple]:
        if not partition.uri:
            return
        store, path = open_store(partition.uri)
        with store.open_input_file(path) as file:
            source, offset = _Source(file), 0
            while offset < source.size:
                member = (Member if source.at(offset, 2) == b"\x1f\x8b" else PlainRecord)(source, offset)
                row, length = self._record(member)
                if row is not None:
                    yield row
                offset = member.next_offset(length)

    def _record(self, member: Member | PlainRecord) -> tuple[tuple | None, int]:
        """The record's row, None if it is not wanted, and the bytes of the record."""
        head, upto = member.read(_HEAD), _HEAD
        while (end := head.find(b"\r\n\r\n")) < 0 and not member.eof:
            upto *= 2
            head = member.read(upto)
        lines = head[:end].split(b"\r\n")
        if not lines[0].startswith(b"WARC/"):
            raise ValueError(f"no WARC record at byte {member.offset}")
        f = _fields(lines[1:])
        block, length = end + 4, int(f["content-length"])
        whole = block + length + 4
        http, http_end = {}, block
        if f.get("content-type", "").startswith("application/http"):
            while (found := head.find(b"\r\n\r\n", block)) < 0 and not member.eof and len(head) < block + length:
                upto *= 2
                head = member.read(upto)
            if 0 <= found < block + length:  # else there are no headers, or the block is all headers
                http, http_end = _fields(head[block:found].split(b"\r\n")[1:]), found + 4
        kind = f.get("warc-type")
        stored = block + length - http_end
        row = {"record_type": kind, "page_id": _number(f.get("x-page-id")), "url": f.get("warc-target-uri"),
               "record_id": f.get("warc-record-id"), "date": f.get("warc-date"), "refers_to": _number(f.get("x-refers-to-page-id")),
               "payload_digest": (f.get("warc-payload-digest") or "").removeprefix("sha1:") or None,
               "payload_bytes": _number(http.get("content-length")) if kind == "revisit" else stored}
        if not self._wanted(row):
            return None, whole
        ok, payload = None, None
        if self.payload != "skip" and kind != "revisit":
            payload = bytes(member.read(block + length)[http_end:block + length])
            if len(payload) < stored:
                raise ValueError(f"the record at byte {member.offset} is cut short")
            ok = row["payload_digest"] is None or digest_of(payload) == row["payload_digest"]
        return (*(row[c] for c in _COLUMNS), ok, payload if self.payload == "keep" else None), whole


class WarcSource(DataSource):
    """``spark.read.format("warc").option("payload", "keep" | "check" | "skip").load(folder)``"""

    @classmethod
    def name(cls) -> str:
        return "warc"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> DataSourceReader:
        return WarcReader(dict(self.options))


def read_archives(spark: SparkSession, folder: str, payload: str = "keep") -> DataFrame:
    """The records of a folder of archives, through the data source."""
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(WarcSource)
    return spark.read.format("warc").option("payload", payload).load(folder)
