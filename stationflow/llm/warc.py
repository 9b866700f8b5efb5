"""WARC archives as a Spark data source, and the writing of pages with revisit records.

``spark.read.format("warc")`` plans a task per file.  Predicates on the record type and on header
columns are pushed down: a task unpacks a record's headers first and goes on to the next record,
by the length that its gzip member states, if they do not hold or if no payload is asked for.
``df.write.format("warc")`` writes gzip members with that length.
"""

from __future__ import annotations

import struct
import uuid
import zlib
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.datasource import (
    DataSource, DataSourceArrowWriter, DataSourceReader, EqualNullSafe, EqualTo, Filter, In, InputPartition, IsNotNull, IsNull,
    StringContains, StringEndsWith, StringStartsWith, WriterCommitMessage,
)
from pyspark.sql.types import StructType
from pyarrow import fs

from stationflow.llm.common import fixed
from stationflow.session import scratch
from stationflow.sources.files import filesystem_of, open_uri

SCHEMA = (
    "record_id string, record_type string, target_uri string, refers_to string, payload_digest string, "
    "payload_bytes long, payload binary"
)
# WARC header of each header column.
HEADERS = {
    "record_id": "warc-record-id", "record_type": "warc-type", "target_uri": "warc-target-uri",
    "refers_to": "warc-refers-to", "payload_digest": "warc-payload-digest",
}
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DATE = "1970-01-01T00:00:00Z"
# Uncompressed bytes after which a writer begins its next file.
FILE_BYTES = 256 << 20
LEVEL = 3
# Bytes unpacked at first, to see a record's headers, and read from the file at once.
HEAD_BYTES = 4 << 10
READ_BYTES = 1 << 20
# Payloads from this size on are stored once.
LEAST_SHARED_BYTES = 100

# Fixed fields of a gzip member with its length in the extra field, 24 bytes.
_GZIP, _GZIP_SIZE = "<4sIBBH2sHII", 24


def _header_value(value: str) -> str:
    """A value without line breaks and control characters, which would end the header."""
    return "".join(c if c >= " " and c != "\x7f" else f"%{ord(c):02X}" for c in value)


def record(row: dict) -> bytes:
    """One WARC record, uncompressed; a revisit holds only the HTTP header of the response."""
    payload, revisit = row["payload"] or b"", row["record_type"] == "revisit"
    size = row["payload_bytes"] if row["payload_bytes"] is not None else len(payload)
    block = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=UTF-8\r\nContent-Length: {size}\r\n\r\n".encode()
    if not revisit:
        block += payload
    lines = ["WARC/1.1", f"WARC-Type: {row['record_type']}", f"WARC-Record-ID: <{row['record_id']}>", f"WARC-Date: {DATE}"]
    if row["target_uri"] is not None:
        lines.append(f"WARC-Target-URI: {_header_value(row['target_uri'])}")
    if row["payload_digest"] is not None:
        lines.append(f"WARC-Payload-Digest: sha256:{row['payload_digest']}")
    if revisit:
        lines += [f"WARC-Profile: {REVISIT_PROFILE}", f"WARC-Refers-To: <{row['refers_to']}>"]
    lines += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}", "", ""]
    return "\r\n".join(lines).encode() + block + b"\r\n\r\n"


def gzip_member(data: bytes) -> bytes:
    """A gzip member whose extra field ``sl`` states its whole length and that of its content."""
    packer = zlib.compressobj(LEVEL, zlib.DEFLATED, -15)
    body = packer.compress(data) + packer.flush()
    tail = struct.pack("<II", zlib.crc32(data), len(data) & 0xFFFFFFFF)
    length = _GZIP_SIZE + len(body) + len(tail)
    if max(length, len(data)) >> 32:
        return struct.pack("<4sIBB", b"\x1f\x8b\x08\x00", 0, 0, 255) + body + tail
    return struct.pack(_GZIP, b"\x1f\x8b\x08\x04", 0, 0, 255, 12, b"sl", 8, length, len(data)) + body + tail


class _Member:
    """One gzip member of an open file: its first bytes, the rest on demand, and where it ends."""

    def __init__(self, file, at: int) -> None:
        self.file, self.start = file, at
        file.seek(at)
        head = file.read(HEAD_BYTES)
        if len(head) < 10 or head[:3] != b"\x1f\x8b\x08":
            raise ValueError(f"no gzip member at byte {at}")
        place, self.length = 10, None
        if head[3] & 4:
            size = struct.unpack_from("<H", head, 10)[0]
            extra, place = head[12 : 12 + size], 12 + size
            while len(extra) >= 4:
                name, n = extra[:2], struct.unpack_from("<H", extra, 2)[0]
                if name == b"sl" and n == 8:
                    self.length = struct.unpack_from("<I", extra, 4)[0]
                extra = extra[4 + n :]
        for flag in (8, 16):
            if head[3] & flag:
                place = head.index(b"\0", place) + 1
        place += 2 if head[3] & 2 else 0
        self.unpacker = zlib.decompressobj(-15)
        self.data = self.unpacker.decompress(head[place:], HEAD_BYTES)
        self.next = at + len(head)

    def more(self, most: int = 0) -> bool:
        """Unpack further, ``most`` bytes or all that is at hand; False at the end."""
        if self.unpacker.eof:
            return False
        source = self.unpacker.unconsumed_tail
        if not source:
            self.file.seek(self.next)
            source = self.file.read(READ_BYTES)
            self.next += len(source)
            if not source:
                raise ValueError(f"the gzip member at byte {self.start} is cut off")
        self.data += self.unpacker.decompress(source, most)
        return True

    def head(self) -> int:
        """Unpack until the headers' end, which may be as far as the member's, and return it."""
        seen = 0
        while (end := self.data.find(b"\r\n\r\n", seen)) < 0:
            # Unpacking as much again each time keeps long headers linear.
            seen = max(0, len(self.data) - 3)
            if not self.more(max(HEAD_BYTES, len(self.data))):
                raise ValueError(f"the record at byte {self.start} has no end of headers")
        return end + 4

    def whole(self) -> bytes:
        parts = [self.data]
        while not self.unpacker.eof:
            self.data = b""
            self.more()
            parts.append(self.data)
        self.data = b"".join(parts)
        return self.data

    def end(self) -> int:
        """Where the next member begins; without a stated length the member is unpacked to find out."""
        if self.length is not None:
            return self.start + self.length
        while not self.unpacker.eof:
            self.data = b""
            self.more()
        return self.next - len(self.unpacker.unused_data) + 8


def _headers(data: bytes) -> dict[str, str]:
    found: dict[str, str] = {}
    for line in data.decode("utf-8", "replace").split("\r\n")[1:]:
        name, colon, value = line.partition(":")
        if colon:
            found[name.strip().lower()] = value.strip()
    return found


def _column(name: str, headers: dict[str, str]) -> str | None:
    value = headers.get(HEADERS[name])
    if value is None:
        return None
    if name in ("record_id", "refers_to"):
        return value.strip("<>")
    return value.removeprefix("sha256:") if name == "payload_digest" else value


def _test(f: Filter) -> tuple[str, Callable[[str | None], bool]] | None:
    """The header column and the test that a filter stands for, None if it is none of headers."""
    name = f.attribute[0] if len(f.attribute) == 1 else None
    if name not in HEADERS:
        return None
    match f:
        case EqualTo():
            return name, lambda v: v is not None and v == f.value
        case EqualNullSafe():
            return name, lambda v: v == f.value
        case In():
            return name, lambda v: v is not None and v in f.value
        case StringStartsWith():
            return name, lambda v: v is not None and v.startswith(f.value)
        case StringEndsWith():
            return name, lambda v: v is not None and v.endswith(f.value)
        case StringContains():
            return name, lambda v: v is not None and f.value in v
        case IsNotNull():
            return name, lambda v: v is not None
        case IsNull():
            return name, lambda v: v is None
    return None


class _File(InputPartition):
    def __init__(self, path: str) -> None:
        super().__init__(path)
        self.path = path


class WarcReader(DataSourceReader):
    def __init__(self, path: str, payloads: bool) -> None:
        self.path, self.payloads, self.filters = path, payloads, []

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:
        """Takes the filters on header columns; Spark applies the others itself."""
        for f in filters:
            if _test(f) is None:
                yield f
            else:
                self.filters.append(f)

    def partitions(self) -> list[InputPartition]:
        """One partition for each archive below the path, largest first."""
        filesystem, base = filesystem_of(self.path)
        found = filesystem.get_file_info(fs.FileSelector(base, recursive=True))
        files = [f for f in found if f.type == fs.FileType.File and f.path.endswith(".warc.gz") and not f.base_name.startswith(("_", "."))]
        root = self.path[: -len(base)] if self.path.endswith(base) else self.path.split(":")[0] + "://"
        return [_File(f"{root}{f.path}") for f in sorted(files, key=lambda f: (-f.size, f.path))]

    def read(self, partition: _File) -> Iterator[tuple]:
        tests = [_test(f) for f in self.filters]
        # Without any archive Spark reads one empty partition.
        if partition is None or partition.path is None:
            return
        with open_uri(partition.path) as file:
            at, size = 0, file.size()
            while at < size:
                member = _Member(file, at)
                start = member.head()
                headers = _headers(member.data[: start - 4])
                values = {name: _column(name, headers) for name in HEADERS}
                if all(test(values[name]) for name, test in tests):
                    yield self.row(member, start, headers, values)
                at = member.end()

    def row(self, member: _Member, start: int, headers: dict[str, str], values: dict[str, str | None]) -> tuple:
        block = int(headers.get("content-length", 0))
        http = "http" in headers.get("content-type", "")
        payload_bytes, payload, begin = block, None, start
        if http:
            while (end := member.data.find(b"\r\n\r\n", start)) < 0 and member.more(HEAD_BYTES):
                pass
            begin = end + 4
            own = _headers(member.data[start:end])
            payload_bytes = int(own.get("content-length", block - (begin - start)))
        if self.payloads and values["record_type"] != "revisit":
            payload = member.whole()[begin : start + block]
        return (*(values[name] for name in ("record_id", "record_type", "target_uri", "refers_to", "payload_digest")), payload_bytes, payload)


class WarcWriter(DataSourceArrowWriter):
    """Writes records in the order of each task's rows; a file counts when its name is moved into place."""

    def __init__(self, path: str) -> None:
        self.path = path

    def write(self, iterator: Iterator[pa.RecordBatch]) -> WriterCommitMessage:
        filesystem, base = filesystem_of(self.path)
        filesystem.create_dir(base, recursive=True)
        names, sink, written = [], None, 0
        for batch in iterator:
            for row in batch.to_pylist():
                if sink is None:
                    names.append(f"{uuid.uuid4().hex}.warc.gz")
                    sink, written = filesystem.open_output_stream(f"{base}/_{names[-1]}", compression=None), 0
                data = record(row)
                sink.write(gzip_member(data))
                written += len(data)
                if written >= FILE_BYTES:
                    sink = sink.close()
        if sink is not None:
            sink.close()
        return _Written(names)

    def commit(self, messages: list[WriterCommitMessage | None]) -> None:
        filesystem, base = filesystem_of(self.path)
        filesystem.create_dir(base, recursive=True)
        for message in messages:
            for name in message.names if message else []:
                filesystem.move(f"{base}/_{name}", f"{base}/{name}")

    def abort(self, messages: list[WriterCommitMessage | None]) -> None:
        """Files of a failed job keep the leading underscore, which readers pass over."""


class _Written(WriterCommitMessage):
    def __init__(self, names: list[str]) -> None:
        self.names = names


class WarcSource(DataSource):
    """``format("warc")``; option ``payload`` (default true) says whether payloads are read."""

    @classmethod
    def name(cls) -> str:
        return "warc"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema: StructType) -> DataSourceReader:
        return WarcReader(self.options["path"], self.options.get("payload", "true") == "true")

    def writer(self, schema: StructType, overwrite: bool) -> DataSourceArrowWriter:
        if overwrite:
            raise ValueError("archives are only added to a folder")
        return WarcWriter(self.options["path"])


def register(spark: SparkSession) -> SparkSession:
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(WarcSource)
    return spark


def page_records(pages: DataFrame) -> DataFrame:
    """The records of ``pages`` (``page_id, url, html``): one response a payload, the others revisit it.

    Payloads under ``LEAST_SHARED_BYTES`` are always responses.  A null html is an empty payload.
    Rows that repeat the smallest id of a payload are all responses; where all ids of a payload are
    null, so are they.  Only payloads that occur more than once are joined: their table is written
    and Spark broadcasts it if its measured size allows; otherwise a very common one is split by the
    adaptive skew join.
    """
    html = F.coalesce("html", F.lit("")).cast("binary")
    rows = pages.select("page_id", "url", html.alias("payload")).select(
        "*", F.sha2("payload", 256).alias("payload_digest"), F.octet_length("payload").cast("long").alias("payload_bytes")
    )
    shared = (
        rows.where(F.col("payload_bytes") >= LEAST_SHARED_BYTES).groupBy("payload_digest")
        .agg(F.min("page_id").alias("first"), F.count("*").alias("n")).where("n > 1").select(F.col("payload_digest").alias("digest"), "first")
    )
    shared = fixed(shared, "shared-payloads")
    rows = rows.join(shared, (F.col("payload_digest") == F.col("digest")) & (F.col("payload_bytes") >= LEAST_SHARED_BYTES), "left")
    revisit = F.col("first").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first"))
    name = lambda c: F.concat(F.lit("urn:page:"), F.coalesce(c.cast("string"), F.lit("")))
    return rows.select(
        name(F.col("page_id")).alias("record_id"),
        F.when(revisit, "revisit").otherwise("response").alias("record_type"),
        F.col("url").alias("target_uri"),
        F.when(revisit, name(F.col("first"))).alias("refers_to"),
        "payload_digest",
        "payload_bytes",
        F.when(~revisit, F.col("payload")).alias("payload"),
    )


def write_pages(pages: DataFrame, folder: str | None = None) -> str:
    """Write the pages as archives below a folder of the shared store and return it."""
    spark = register(pages.sparkSession)
    folder = folder or scratch(spark, "warc")
    page_records(pages).write.format("warc").mode("append").save(folder)
    return folder


def read_pages(spark: SparkSession, folder: str) -> DataFrame:
    """One row per page from the archives; a response's digest and size are measured on its payload."""
    archive = register(spark).read.format("warc").load(folder)
    page = lambda c: F.regexp_extract(c, r"^urn:page:(-?[0-9]+)$", 1).try_cast("long")
    stored = F.col("payload").isNotNull()
    return archive.select(
        page(F.col("record_id")).alias("page_id"),
        F.when(stored, F.octet_length("payload").cast("long")).otherwise(F.col("payload_bytes")).alias("payload_bytes"),
        F.when(stored, F.sha2("payload", 256)).otherwise(F.col("payload_digest")).alias("payload_digest"),
        "record_type",
        page(F.col("refers_to")).alias("refers_to"),
    )
