"""WARC records in ZIP packages: written by tasks, read back by byte ranges.

A package is a ZIP archive whose members are stored: ``archive/data.warc`` with the records and
``indexes/index.cdxj`` with one line per record (page id, place in the member, length). The reader
parses the end record, the ZIP64 locator and end record, and the central directory itself, finds
where a stored member begins, and then reads ranges: the index in pieces, and records in runs of
about ``RUN_BYTES``. Nothing is extracted and no member is read whole. Packages of others can be
read as well, as long as the wanted members are stored.

Payloads that occur once more are not stored again: of records with equal payloads of at least
``min_bytes`` the one with the largest page id is the response, the others are revisits of it.

A task writes its packages under names of its own and reports them; only reports of tasks that
finished are in the manifest, so a repeated or lost task leaves at most unused files. Files are opened
through ``pyarrow.fs`` by URI (local or mounted, HDFS, S3, GCS), in the folder of spark.checkpoint.dir.

Defined cases: a null html is an empty payload; equal empty payloads are revisits as others are. A
null url is written without a target. A null page id is written as such; it is a response only if all ids
of its payload are null. Rows that share the largest id and the payload are all responses. Long
payloads form records of any length; a run is never shorter than a record. An empty table gives an
empty manifest and result. Other columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import io
import json
import posixpath
import struct
import uuid
import zipfile
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.llm.common import Staged, in_slices, join_measured, new_shared_path, stage, table

RECORDS = "archive/data.warc"
INDEX = "indexes/index.cdxj"
PACKAGE_BYTES = 64 * 1024 * 1024
RUN_BYTES = 4 * 1024 * 1024
MIN_BYTES = 0
#: Bytes that one task reads back, and the bytes of a package that its index weighs like.
TASK_BYTES = 64 * 1024 * 1024
INDEX_SHARE = 16

# Fixed values of the ZIP format.
_END, _END_SIZE = b"PK\x05\x06", 22
_END64_PLACE, _END64_PLACE_SIZE = b"PK\x06\x07", 20
_END64, _END64_SIZE = b"PK\x06\x06", 56
_CENTRAL, _CENTRAL_SIZE = b"PK\x01\x02", 46
_LOCAL, _LOCAL_SIZE = b"PK\x03\x04", 30
_EXTRA64 = 0x0001
_FULL16, _FULL32 = 0xFFFF, 0xFFFFFFFF
_COMMENT_MAX = 0xFFFF


@dataclass(frozen=True)
class Member:
    """A stored member: its name and where its bytes lie in the archive."""

    name: str
    start: int
    size: int


class Package:
    """Ranges of one ZIP archive. ``read(offset, size)`` gives bytes of the file."""

    def __init__(self, read, size: int):
        self._read, self._size = read, size

    def _directory_place(self) -> tuple[int, int, int]:
        """Start, size and number of entries of the central directory."""
        tail_size = min(self._size, _END_SIZE + _COMMENT_MAX + _END64_PLACE_SIZE)
        tail_start = self._size - tail_size
        tail = self._read(tail_start, tail_size)
        at = tail.rfind(_END)
        while at >= 0:  # a comment may hold the signature; the true one ends the file
            if at + _END_SIZE <= len(tail):
                (comment,) = struct.unpack_from("<H", tail, at + 20)
                if at + _END_SIZE + comment == len(tail):
                    break
            at = tail.rfind(_END, 0, at)
        if at < 0:
            raise ValueError("not a ZIP archive: no end record")
        count, size, start = struct.unpack_from("<HII", tail, at + 10)
        place = at - _END64_PLACE_SIZE
        if place >= 0 and tail[place : place + 4] == _END64_PLACE:
            (end64,) = struct.unpack_from("<Q", tail, place + 8)
            record = self._read(end64, _END64_SIZE)
            if record[:4] != _END64:
                raise ValueError("no ZIP64 end record where its locator points")
            count, size, start = struct.unpack_from("<QQQ", record, 32)
        elif count == _FULL16 or size == _FULL32 or start == _FULL32:
            raise ValueError("a ZIP64 archive without locator")
        return start, size, count

    def entries(self, piece: int = 1 << 20) -> Iterator[tuple[str, int, int, int]]:
        """Name, method, size and place of the local header of every entry, reading in pieces."""
        start, size, count = self._directory_place()
        end, held = start + size, b""
        for _ in range(count):
            while len(held) < _CENTRAL_SIZE or len(held) < _central_length(held):
                if start >= end:
                    raise ValueError("the central directory is cut off")
                held += (got := self._read(start, min(piece, end - start)))
                start += len(got)
            if held[:4] != _CENTRAL:
                raise ValueError("no central directory entry")
            flags, method = struct.unpack_from("<HH", held, 8)
            packed, plain, name_n, extra_n = struct.unpack_from("<IIHH", held, 20)
            (place,) = struct.unpack_from("<I", held, 42)
            name = held[_CENTRAL_SIZE : _CENTRAL_SIZE + name_n]
            extra = held[_CENTRAL_SIZE + name_n : _CENTRAL_SIZE + name_n + extra_n]
            plain, packed, place = _widened(extra, plain, packed, place)
            held = held[_central_length(held) :]
            yield name.decode("utf-8" if flags & 0x800 else "cp437"), method, plain, place

    def member(self, name: str) -> Member:
        """Where a stored member begins; its local header tells, as its extra field may differ."""
        for found, method, size, place in self.entries():
            if found == name:
                if method != zipfile.ZIP_STORED:
                    raise ValueError(f"{name} is compressed; only stored members have ranges")
                head = self._read(place, _LOCAL_SIZE)
                if head[:4] != _LOCAL:
                    raise ValueError(f"no local header of {name}")
                name_n, extra_n = struct.unpack_from("<HH", head, 26)
                return Member(name, place + _LOCAL_SIZE + name_n + extra_n, size)
        raise KeyError(name)

    def read(self, member: Member, offset: int, size: int) -> bytes:
        if offset < 0 or offset + size > member.size:
            raise ValueError(f"range outside of {member.name}")
        return self._read(member.start + offset, size)

    def lines(self, member: Member, piece: int = 1 << 20) -> Iterator[bytes]:
        """Lines of a member, read in pieces."""
        at, held = 0, b""
        while at < member.size:
            got = self.read(member, at, min(piece, member.size - at))
            at += len(got)
            *whole, held = (held + got).split(b"\n")
            yield from whole
        if held:
            yield held


def _central_length(entry: bytes) -> int:
    name_n, extra_n, comment_n = struct.unpack_from("<HHH", entry, 28)
    return _CENTRAL_SIZE + name_n + extra_n + comment_n


def _widened(extra: bytes, plain: int, packed: int, place: int) -> tuple[int, int, int]:
    """The three numbers, taken from the ZIP64 field where the entry's own are full."""
    values, at = [plain, packed, place], 0
    while at + 4 <= len(extra):
        kind, size = struct.unpack_from("<HH", extra, at)
        if kind == _EXTRA64:
            field, used = extra[at + 4 : at + 4 + size], 0
            for i, v in enumerate(values):
                if v == _FULL32:
                    (values[i],) = struct.unpack_from("<Q", field, used)
                    used += 8
        at += 4 + size
    return values[0], values[1], values[2]


def open_package(uri: str) -> tuple[Package, object]:
    """The package behind a URI and the open file, which the caller closes."""
    system, path = fs.FileSystem.from_uri(uri)
    file = system.open_input_file(path)
    return Package(lambda offset, size: file.read_at(size, offset), file.size()), file


def digest_of(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode("ascii")


def _record(row: dict) -> bytes:
    """One WARC record: a response with its payload, or a revisit without."""
    revisit = row["refers_to"] is not None
    payload = row["payload"]
    fields = [("WARC-Type", "revisit" if revisit else "response"), ("WARC-Record-ID", f"<urn:uuid:{uuid.uuid4()}>")]
    fields.append(("WARC-Date", "2000-01-01T00:00:00Z"))
    if row["url"] is not None:
        fields.append(("WARC-Target-URI", " ".join(row["url"].split())))
    fields += [("WARC-Payload-Digest", f"sha1:{row['digest']}"), ("WARC-Payload-Length", str(len(payload)))]
    if row["page_id"] is not None:
        fields.append(("WARC-Page-ID", str(row["page_id"])))
    if revisit:
        fields.append(("WARC-Refers-To-Page-ID", str(row["refers_to"])))
        payload = b""
    fields += [("Content-Type", "text/html; charset=utf-8"), ("Content-Length", str(len(payload)))]
    head = "WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in fields) + "\r\n"
    return head.encode("utf-8") + payload + b"\r\n\r\n"


def records_of(data: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """Fields and block of the records that follow each other in ``data``."""
    at = 0
    while at < len(data):
        end = data.index(b"\r\n\r\n", at)
        first, *lines = data[at:end].decode("utf-8").split("\r\n")
        if not first.startswith("WARC/"):
            raise ValueError("no WARC record")
        fields = dict(line.split(": ", 1) for line in lines)
        start, size = end + 4, int(fields["Content-Length"])
        if start + size > len(data):
            raise ValueError("a WARC record is cut off")
        yield fields, data[start : start + size]
        at = start + size + 4


class _Writer:
    """One package under a name of its own."""

    def __init__(self, folder: str):
        self.uri = f"{folder}/{uuid.uuid4().hex}.zip"
        system, path = fs.FileSystem.from_uri(self.uri)
        system.create_dir(posixpath.dirname(path), recursive=True)
        self._out = system.open_output_stream(path)
        self._zip = zipfile.ZipFile(self._out, "w", zipfile.ZIP_STORED, allowZip64=True)
        self._records = self._zip.open(RECORDS, "w", force_zip64=True)
        self._index, self.size, self.rows = io.BytesIO(), 0, 0

    def add(self, row: dict) -> None:
        data = _record(row)
        self._records.write(data)
        entry = {"page_id": row["page_id"], "offset": self.size, "length": len(data)}
        self._index.write(json.dumps(entry).encode("ascii") + b"\n")
        self.size += len(data)
        self.rows += 1

    def close(self) -> tuple[str, int, int]:
        self._records.close()
        with self._zip.open(INDEX, "w", force_zip64=True) as index:
            index.write(self._index.getbuffer())
        self._zip.close()
        self._out.close()
        return self.uri, self.rows, self.size


def _folder_uri(path: str) -> str:
    return path if "://" in path or path.startswith("file:") else f"file://{path}"


def with_types(pages: DataFrame, min_bytes: int = MIN_BYTES) -> DataFrame:
    """page_id, url, payload, digest and refers_to (null for responses) of every page."""
    payload = F.coalesce(F.col("html"), F.lit("")).cast("binary")
    given = pages.select("page_id", "url", payload.alias("payload"), F.sha1(payload).alias("sha1"))
    groups = given.filter(F.octet_length("payload") >= min_bytes).groupBy("sha1").agg(
        F.max("page_id").alias("response"), F.count(F.lit(1)).alias("n")
    )
    again = stage(groups.filter("n > 1 and response is not null").select("sha1", "response"), "equal-payloads")
    known = join_measured(given, again, ["sha1"], "left")
    other = F.col("response").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("response"))
    return known.select("page_id", "url", "payload", F.when(other, F.col("response")).alias("refers_to"))


def write_packages(typed: DataFrame, folder: str, package_bytes: int = PACKAGE_BYTES) -> Staged:
    """Writes the records into packages below ``folder``; gives the manifest: uri, records, bytes."""
    folder = _folder_uri(folder)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        writer, done = None, []
        for batch in batches:
            for at in range(0, batch.num_rows, 64):
                for row in batch.slice(at, 64).to_pylist():
                    writer = writer or _Writer(folder)
                    writer.add(row | {"digest": digest_of(row["payload"])})
                    if writer.size >= package_bytes:
                        done.append(writer.close())
                        writer = None
        if writer:
            done.append(writer.close())
        uris, rows, sizes = zip(*done, strict=True) if done else ((), (), ())
        yield pa.RecordBatch.from_arrays(
            [pa.array(uris, pa.string()), pa.array(rows, pa.int64()), pa.array(sizes, pa.int64())], names=["uri", "records", "bytes"]
        )

    columns = typed.select("page_id", "url", "payload", "refers_to")
    return stage(columns.mapInArrow(run, "uri string, records bigint, bytes bigint"), "package-manifest", total=F.sum("bytes"))


def record_runs(manifest: DataFrame, run_bytes: int = RUN_BYTES) -> DataFrame:
    """uri, start, length: ranges of whole, neighbouring records, from the indexes of the packages."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for uri in batch.column("uri").to_pylist():
                package, file = open_package(uri)
                out, first, size = [], 0, 0
                with file:
                    member, index = package.member(RECORDS), package.member(INDEX)
                    for line in package.lines(index):
                        entry = json.loads(line)
                        if size and (size + entry["length"] > run_bytes or entry["offset"] != first + size):
                            out.append((uri, member.start + first, size))
                            size = 0
                        if not size:
                            first = entry["offset"]
                        size += entry["length"]
                if size:
                    out.append((uri, member.start + first, size))
                uris, starts, lengths = zip(*out, strict=True) if out else ((), (), ())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(uris, pa.string()), pa.array(starts, pa.int64()), pa.array(lengths, pa.int64())],
                    names=["uri", "start", "length"],
                )

    return manifest.select("uri").mapInArrow(run, "uri string, start bigint, length bigint")


def dealt(rows: DataFrame, size: int) -> DataFrame:
    """Rows that point to ``size`` bytes, dealt to tasks by those bytes and not by their own."""
    parallel = rows.sparkSession.sparkContext.defaultParallelism
    return rows.repartition(max(1, -(-size // TASK_BYTES), min(parallel, -(-size // RUN_BYTES))))


def read_records(runs: DataFrame, payloads: bool = True) -> DataFrame:
    """One row per record of the ranges, each read by one request: page_id, record_type, refers_to,
    payload_bytes and payload_digest of the full payload, checked against the bytes of a response, and
    the payload itself (null for revisits)."""
    schema = "page_id bigint, record_type string, refers_to bigint, payload_bytes bigint, payload_digest string"
    schema += ", payload binary" * payloads

    def make():
        def work(rows):
            out: dict[str, list] = {c.strip().split(" ")[0]: [] for c in schema.split(",")}
            for uri, start, length in zip(rows["uri"], rows["start"], rows["length"], strict=True):
                system, path = fs.FileSystem.from_uri(uri)
                with system.open_input_file(path) as file:
                    data = file.read_at(length, start)
                for fields, block in records_of(data):
                    _append(out, fields, block)
            return out

        return work

    return in_slices(runs.select("uri", "start", "length"), make, schema, rows=1)


def _append(out: dict[str, list], fields: dict[str, str], block: bytes) -> None:
    kind = fields["WARC-Type"]
    digest, size = fields["WARC-Payload-Digest"].removeprefix("sha1:"), int(fields["WARC-Payload-Length"])
    if kind == "response" and (digest_of(block) != digest or len(block) != size):
        raise ValueError(f"record {fields['WARC-Record-ID']}: payload and digest differ")
    page, refers = fields.get("WARC-Page-ID"), fields.get("WARC-Refers-To-Page-ID")
    row = {
        "page_id": page and int(page),
        "record_type": kind,
        "refers_to": refers and int(refers),
        "payload_bytes": size,
        "payload_digest": digest,
        "payload": block if kind == "response" else None,
    }
    for name in out:
        out[name].append(row[name])


def op3_pages_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select(F.col("page_id").cast("long").alias("page_id"), "url", "html")
    manifest = write_packages(with_types(pages), new_shared_path(spark, "packages"))
    size = manifest.metrics["total"] or 0
    runs = record_runs(dealt(manifest.df, size // INDEX_SHARE))
    return read_records(dealt(runs, size), payloads=False)


OP3_SQL = """
WITH p AS (
  SELECT page_id, coalesce(html, '') AS payload, sha1(coalesce(html, '')) AS h FROM pages
), g AS (
  SELECT h, max(page_id) AS response FROM p GROUP BY h
)
SELECT page_id,
  CAST(strlen(payload) AS BIGINT) AS payload_bytes,
  array_to_string(list_transform(range(0, 32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
    1 + ((CAST('0x' || substr(h, CAST(1 + 5 * (i // 4) AS INTEGER), 5) AS BIGINT) >> (5 * (3 - i % 4))) & 31), 1)), '') AS payload_digest,
  CASE WHEN page_id = response THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id <> response THEN response END AS refers_to
FROM p JOIN g USING (h)
"""
