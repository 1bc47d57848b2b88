"""Web archives: WARC records packed in ZIP files, written and range-read.

Each package holds two stored members: ``archive/data.warc.gz``, one gzip member per record, and
``indexes/index.cdxj``, one line per record with its place in the first.  A reader needs only the
end of a package, its directory and its index to fetch any record by one range read.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import io
import json
import re
import struct
import uuid
import zipfile
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators import match_unique
from ..storage import materialize, new_folder
from .arrays import released

RECORDS = "archive/data.warc.gz"
INDEX = "indexes/index.cdxj"
# Record signatures and sizes of the ZIP format.
_END, _END64, _LOCATOR, _ENTRY, _LOCAL = b"PK\5\6", b"PK\6\6", b"PK\6\7", b"PK\1\2", b"PK\3\4"
_FULL16, _FULL32 = 0xFFFF, 0xFFFFFFFF


@dataclass(frozen=True)
class Member:
    name: str
    method: int
    header: int
    packed: int
    size: int


def _range(file, start: int, size: int) -> bytes:
    file.seek(start)
    data = file.read(size)
    if len(data) != size:
        raise ValueError("the package ends too early")
    return data


def read_directory(file, length: int) -> list[Member]:
    """The members of a ZIP package, from its central directory, with ZIP64 fields where they are used.

    Reads the end record (with a comment of any length), the directory, and nothing else.
    """
    tail_size = min(length, 22 + _FULL16)
    tail = _range(file, length - tail_size, tail_size)
    at = tail.rfind(_END)
    # The record's signature may also stand in the comment after it.
    while at >= 0 and (at + 22 > tail_size or at + 22 + struct.unpack_from("<H", tail, at + 20)[0] != tail_size):
        at = tail.rfind(_END, 0, at)
    if at < 0:
        raise ValueError("no end of central directory")
    end = length - tail_size + at
    count, size, start = struct.unpack_from("<HII", tail, at + 10)
    if count == _FULL16 or size == _FULL32 or start == _FULL32:
        locator = _range(file, end - 20, 20)
        if locator[:4] != _LOCATOR:
            raise ValueError("no ZIP64 locator")
        record = _range(file, struct.unpack_from("<Q", locator, 8)[0], 56)
        if record[:4] != _END64:
            raise ValueError("no ZIP64 end of central directory")
        count, size, start = struct.unpack_from("<QQQ", record, 32)
    directory, members, at = _range(file, start, size), [], 0
    for _ in range(count):
        if directory[at : at + 4] != _ENTRY:
            raise ValueError("broken central directory")
        flags, method = struct.unpack_from("<HH", directory, at + 8)
        packed, plain, name, extra, comment = struct.unpack_from("<IIHHH", directory, at + 20)
        header = struct.unpack_from("<I", directory, at + 42)[0]
        fields = directory[at + 46 + name : at + 46 + name + extra]
        wide, place = [], 0
        while place + 4 <= len(fields):
            kind, width = struct.unpack_from("<HH", fields, place)
            if kind == 1:
                wide = list(struct.unpack_from(f"<{width // 8}Q", fields, place + 4))
            place += 4 + width
        # The ZIP64 field holds only those values, in this order, that did not fit.
        plain = wide.pop(0) if plain == _FULL32 else plain
        packed = wide.pop(0) if packed == _FULL32 else packed
        header = wide.pop(0) if header == _FULL32 else header
        raw = directory[at + 46 : at + 46 + name]
        members.append(Member(raw.decode("utf-8" if flags & 0x800 else "cp437"), method, header, packed, plain))
        at += 46 + name + extra + comment
    return members


def stored_range(file, member: Member) -> tuple[int, int]:
    """Where the bytes of a stored member lie in the package: start and size."""
    if member.method != 0:
        raise ValueError(f"{member.name} is compressed by the package; records can only be read from stored members")
    header = _range(file, member.header, 30)
    if header[:4] != _LOCAL:
        raise ValueError("broken local header")
    name, extra = struct.unpack_from("<HH", header, 26)
    return member.header + 30 + name + extra, member.size


def warc_record(kind: str, key: int | None, uri: str | None, digest: str, refers: int | None, payload: bytes, length: int) -> bytes:
    """One WARC record of an HTTP response; a revisit has its HTTP header only."""
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % length
    block = http if kind == "revisit" else http + payload
    head = ["WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: <urn:page:{'' if key is None else key}>"]
    head += ["WARC-Date: 1970-01-01T00:00:00Z", "Content-Type: application/http;msgtype=response"]
    head.append(f"WARC-Payload-Digest: sha1:{digest}")
    if uri is not None:
        safe = re.sub(r"[\x00-\x20\x7f]", lambda c: "%%%02X" % ord(c[0]), uri)
        head.append(f"WARC-Target-URI: {safe}")
    if kind == "revisit":
        head.append("WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")
        head.append(f"WARC-Refers-To: <urn:page:{'' if refers is None else refers}>")
    head.append(f"Content-Length: {len(block)}")
    return "\r\n".join(head).encode("utf-8", "surrogatepass") + b"\r\n\r\n" + block + b"\r\n\r\n"


@dataclass(frozen=True)
class Record:
    kind: str
    key: int | None
    uri: str | None
    digest: str
    refers: int | None
    length: int
    payload: bytes | None


def parse_record(raw: bytes) -> Record:
    """A record from its bytes; checks its lengths and, where it has a payload, the payload's digest."""
    head, _, rest = raw.partition(b"\r\n\r\n")
    version, *lines = head.decode("utf-8", "surrogatepass").split("\r\n")
    if not version.startswith("WARC/1."):
        raise ValueError("not a WARC record")
    fields = dict(line.split(": ", 1) for line in lines)
    block = rest[: int(fields["Content-Length"])]
    if len(block) != int(fields["Content-Length"]) or rest[len(block) :] != b"\r\n\r\n":
        raise ValueError("a record's length is wrong")
    http, _, payload = block.partition(b"\r\n\r\n")
    length = int(re.search(rb"(?mi)^Content-Length: (\d+)", http)[1])
    digest = fields["WARC-Payload-Digest"].removeprefix("sha1:")

    def page(name: str) -> int | None:
        number = fields.get(name, "").removeprefix("<urn:page:").removesuffix(">")
        return int(number) if number else None

    if fields["WARC-Type"] == "revisit":
        payload = None
    elif len(payload) != length or payload_digest(payload) != digest:
        raise ValueError("a payload does not match its record")
    return Record(fields["WARC-Type"], page("WARC-Record-ID"), fields.get("WARC-Target-URI"), digest, page("WARC-Refers-To"), length, payload)


def payload_digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


class _Package:
    """A package being written; records are packed one after the other, the index goes last."""

    def __init__(self, folder: str, number: int):
        attempt = TaskContext.get().taskAttemptId() if TaskContext.get() else 0
        self.path = f"{folder}/{number:06d}-{attempt}-{uuid.uuid4().hex[:12]}.zip"
        system, name = fs.FileSystem.from_uri(self.path)
        system.create_dir(name.rpartition("/")[0], recursive=True)
        self.file = system.open_output_stream(name)
        self.zip = zipfile.ZipFile(_Sink(self.file), "w", zipfile.ZIP_STORED)
        self.member = self.zip.open(zipfile.ZipInfo(RECORDS), "w", force_zip64=True)
        self.index = io.BytesIO()
        self.size = self.records = 0

    def add(self, record: bytes, key: int | None, uri: str | None, level: int) -> None:
        packed = gzip.compress(record, level, mtime=0)
        self.member.write(packed)
        place = {"url": uri, "page": key, "offset": self.size, "length": len(packed)}
        self.index.write(b"%s 19700101000000 %s\n" % (b"" if key is None else b"%d" % key, json.dumps(place).encode()))
        self.size += len(packed)
        self.records += 1

    def close(self) -> tuple[str, int, int]:
        self.member.close()
        with self.zip.open(zipfile.ZipInfo(INDEX), "w", force_zip64=True) as member:
            member.write(self.index.getbuffer())
        self.zip.close()
        length = self.file.tell()
        self.file.close()
        return self.path, length, self.records


class _Sink(io.RawIOBase):
    """An output stream that cannot seek, as object stores give them."""

    def __init__(self, stream):
        self.stream = stream

    def writable(self) -> bool:
        return True

    def write(self, data) -> int:
        self.stream.write(data)
        return len(data)

    def tell(self) -> int:
        return self.stream.tell()

    def seekable(self) -> bool:
        return False


def mark_revisits(pages: DataFrame, key: str, payload: Column, least: int) -> DataFrame:
    """The pages with ``__payload`` and ``__first``: the largest key of those with an equal payload of at least ``least`` bytes.

    Payloads are told apart by SHA-256; only digests are grouped, pre-aggregated in each task.  ``__first`` is null for
    smaller payloads.
    """
    marked = pages.select("*", payload.alias("__payload"))
    marked = marked.withColumn("__digest", F.unhex(F.sha2("__payload", 256)))
    firsts = marked.filter(F.octet_length("__payload") >= least).groupBy("__digest").agg(F.max(key).alias("__first"))
    return match_unique(marked, firsts, ["__digest"], "left").drop("__digest")


def write_archives(
    pages: DataFrame,
    folder: str,
    *,
    key: str = "page_id",
    uri: str = "url",
    payload: str = "html",
    revisit_bytes: int = 0,
    package_bytes: int = 64 << 20,
    level: int = 3,
) -> DataFrame:
    """Write one record per page into packages below ``folder`` and return them: ``path``, ``length``, ``records``.

    The folder must be one that all executors reach by a path that pyarrow understands.  Each task writes
    packages of about ``package_bytes`` under names of its own attempt; only those in the returned
    (stored) table count, so that what a lost task left behind is never read.

    The payload is the text in UTF-8, empty for null.  Of equal payloads of at least ``revisit_bytes``
    that with the largest key is the response and all others revisit it; pages that repeat the largest
    key with the same payload are responses, too.  Null keys are below all others; a null address is left out.
    A payload of any length is one record, held by itself while it is packed.  Other columns are not used, and an empty table gives
    no package.
    """
    rows = mark_revisits(
        pages.select(F.col(key).cast("bigint").alias("key"), F.col(uri).cast("string").alias("uri"), payload),
        "key",
        F.coalesce(F.col(payload).cast("string"), F.lit("")).cast("binary"),
        revisit_bytes,
    )
    first = F.col("__first")
    refers = F.when(F.col("key").isNull() & first.isNotNull() | (first != F.col("key")), first)
    rows = rows.select("key", "uri", refers.alias("refers"), F.col("__payload").alias("payload"))

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        done, package = [], None
        for batch in batches:
            for key_, uri_, refers_, data in zip(*(c.to_pylist() for c in batch.columns[:3]), batch.column(3)):
                data = data.as_py()
                kind = "response" if refers_ is None else "revisit"
                if package is None:
                    package = _Package(folder, TaskContext.get().partitionId())
                package.add(warc_record(kind, key_, uri_, payload_digest(data), refers_, data, len(data)), key_, uri_, level)
                if package.size >= package_bytes:
                    done.append(package.close())
                    package = None
        if package is not None:
            done.append(package.close())
        columns = zip(*done) if done else ([], [], [])
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(columns, (pa.string(), pa.int64(), pa.int64()))], names=["path", "length", "records"]
        )

    written = rows.mapInArrow(released(packed), "path string, length bigint, records bigint")
    return materialize(written, new_folder(pages.sparkSession, "packages"))


def _open(path: str):
    system, name = fs.FileSystem.from_uri(path)
    return system.open_input_file(name)


def locate_records(packages: DataFrame, *, range_bytes: int = 8 << 20) -> DataFrame:
    """Ranges of records in packages (``path``, ``length``): ``path``, ``start``, ``sizes`` (of the records, one after the other).

    Reads directories and indexes only.  A large package becomes many ranges of about ``range_bytes``.
    """

    def located(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, length in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                with _open(path) as file:
                    members = {m.name: m for m in read_directory(file, length)}
                    start, _ = stored_range(file, members[RECORDS])
                    index = _range(file, *stored_range(file, members[INDEX]))
                places = (json.loads(line.split(b" ", 2)[2]) for line in index.splitlines())
                ranges, at = [], None
                for place in sorted(places, key=lambda p: p["offset"]):
                    if at != place["offset"] or sum(ranges[-1][2]) >= range_bytes:
                        ranges.append((path, start + place["offset"], []))
                    ranges[-1][2].append(place["length"])
                    at = place["offset"] + place["length"]
                columns = zip(*ranges) if ranges else ([], [], [])
                types = (pa.string(), pa.int64(), pa.list_(pa.int64()))
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=["path", "start", "sizes"])

    return packages.select("path", "length").mapInArrow(released(located), "path string, start bigint, sizes array<bigint>")


def read_archives(packages: DataFrame, *, range_bytes: int = 8 << 20, payloads: bool = True) -> DataFrame:
    """One row per record of the packages (``path``, ``length``), range-read without extraction.

    Columns: ``page_id``, ``url``, ``record_type``, ``payload_bytes`` (of the full payload), ``payload_digest``,
    ``refers_to`` and, with ``payloads``, ``payload`` (null for revisits).  Broken packages and records raise errors.
    Records that were written twice are read twice, a record longer than ``range_bytes`` has a range of its own, and an empty table of
    packages gives an empty result.  Other columns are not used.
    """
    schema = "page_id bigint, url string, record_type string, payload_bytes bigint, payload_digest string, refers_to bigint"
    schema += ", payload binary" if payloads else ""
    arrow = (pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.binary())[: 6 + payloads]
    names = [part.split()[0] for part in schema.split(", ")]

    def fetched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, start, sizes in zip(*(c.to_pylist() for c in batch.columns)):
                with _open(path) as file:
                    data = memoryview(_range(file, start, sum(sizes)))
                rows, at = [], 0
                for size in sizes:
                    record = parse_record(zlib.decompress(data[at : at + size], wbits=31))
                    at += size
                    row = (record.key, record.uri, record.kind, record.length, record.digest, record.refers, record.payload)
                    rows.append(row[: len(names)])
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), arrow)], names=names)

    ranges = locate_records(packages.repartition("path"), range_bytes=range_bytes)
    return ranges.repartition("path", "start").mapInArrow(released(fetched), schema)
