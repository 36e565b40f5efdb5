"""Small task-side helpers that read ZIP archives by ranges. They know nothing of Spark."""

import bz2
import io
import struct
import zlib

import pyarrow as pa
from pyarrow import fs

CHUNK_BYTES = 1 << 20
BATCH_LINES = 1 << 15
_UTF8_BOM = b"\xef\xbb\xbf"
_UTF16_BOMS = (b"\xff\xfe", b"\xfe\xff")

# Fixed values of the ZIP format: signatures, record sizes, methods and flags.
_END, _END_BYTES = b"PK\x05\x06", 22
_PLACE64, _PLACE64_BYTES = b"PK\x06\x07", 20
_END64, _END64_BYTES = b"PK\x06\x06", 56
_ENTRY, _ENTRY_BYTES = b"PK\x01\x02", 46
_LOCAL, _LOCAL_BYTES = b"PK\x03\x04", 30
_WIDE_FIELD = 1
_FULL = 0xFFFFFFFF
_STORED, _DEFLATED, _BZIP2 = 0, 8, 12
_ENCRYPTED, _UTF8_NAME = 0x1, 0x800


def open_store(uri):
    """File system and path of a URI as Spark writes it."""
    if uri.startswith("file:"):
        return fs.LocalFileSystem(), "/" + uri[len("file:"):].lstrip("/")
    if uri.startswith("/"):
        return fs.LocalFileSystem(), uri
    for scheme in ("s3a://", "s3n://"):
        if uri.startswith(scheme):
            uri = "s3://" + uri[len(scheme):]
    return fs.FileSystem.from_uri(uri)


def _directory(file):
    """Where the directory of an archive begins and how many bytes it has."""
    size = file.size()
    tail = file.read_at(min(size, _END_BYTES + 0xFFFF + _PLACE64_BYTES), max(0, size - _END_BYTES - 0xFFFF - _PLACE64_BYTES))
    at = tail.rfind(_END)
    while at >= 0 and at + _END_BYTES + int.from_bytes(tail[at + 20:at + 22], "little") != len(tail):
        at = tail.rfind(_END, 0, at)  # a comment may hold the signature
    if at < 0:
        raise ValueError("not a ZIP archive")
    length, start = struct.unpack_from("<II", tail, at + 12)
    place = tail[max(0, at - _PLACE64_BYTES):at]
    if place[:4] == _PLACE64:
        end = file.read_at(_END64_BYTES, struct.unpack_from("<Q", place, 8)[0])
        if end[:4] != _END64:
            raise ValueError("no ZIP64 end record where its locator points")
        length, start = struct.unpack_from("<QQ", end, 40)
    return start, length


def _wide(extra, numbers):
    """The numbers of an entry, full ones taken from its ZIP64 field."""
    while len(extra) >= 4:
        kind, length = struct.unpack_from("<HH", extra)
        if kind == _WIDE_FIELD:
            values = iter(struct.unpack_from(f"<{length // 8}Q", extra, 4))
            return [next(values) if n == _FULL else n for n in numbers]
        extra = extra[4 + length:]
    return numbers


def entries_of(file, piece=CHUNK_BYTES):
    """Directory records of an archive, read piece by piece."""
    at, left = _directory(file)
    held = b""
    while held or left:
        while left and (len(held) < _ENTRY_BYTES or len(held) < _ENTRY_BYTES + sum(struct.unpack_from("<HHH", held, 28))):
            got = file.read_at(min(piece, left), at)
            if not got:
                raise ValueError("the directory of the archive is cut off")
            held, at, left = held + got, at + len(got), left - len(got)
        if held[:4] != _ENTRY:
            raise ValueError("no entry where the directory should hold one")
        flags, method, crc = struct.unpack_from("<HH4xL", held, 8)
        name_end = _ENTRY_BYTES + struct.unpack_from("<H", held, 28)[0]
        extra_end = name_end + struct.unpack_from("<H", held, 30)[0]
        end = extra_end + struct.unpack_from("<H", held, 32)[0]
        numbers = [*struct.unpack_from("<LL", held, 24), *struct.unpack_from("<L", held, 20), *struct.unpack_from("<L", held, 42)]
        plain, packed, start = _wide(held[name_end:extra_end], [numbers[0], numbers[2], numbers[3]])
        name = held[_ENTRY_BYTES:name_end].decode("utf-8" if flags & _UTF8_NAME else "cp437")
        yield {
            "entry": name.partition("\0")[0],
            "bytes": plain,
            "packed_bytes": packed,
            "start": start,
            "method": method,
            "flags": flags,
            "crc": crc,
        }
        held = held[end:]


class EntryStream(io.RawIOBase):
    """The unpacked bytes of one entry, read from its range of the archive."""

    def __init__(self, file, row):
        head = file.read_at(_LOCAL_BYTES, row["start"])
        if head[:4] != _LOCAL:
            raise ValueError(f"no entry at byte {row['start']}")
        if row["flags"] & _ENCRYPTED or row["method"] not in (_STORED, _DEFLATED, _BZIP2):
            raise ValueError(f"{row['entry']} is encrypted or packed by method {row['method']}")
        self._file, self._row = file, row
        self._begin = row["start"] + _LOCAL_BYTES + sum(struct.unpack_from("<HH", head, 26))
        self.seek(0)

    def seek(self, place, whence=io.SEEK_SET):
        """Back to the start; nothing else is asked for."""
        if place or whence != io.SEEK_SET:
            raise io.UnsupportedOperation("only back to the start")
        method = self._row["method"]
        self._unpack = zlib.decompressobj(-15) if method == _DEFLATED else bz2.BZ2Decompressor() if method == _BZIP2 else None
        self._at, self._left = self._begin, self._row["packed_bytes"]
        self._crc, self._given, self._ready = 0, 0, b""
        return 0

    def readable(self):
        return True

    def _more(self, most):
        """Some unpacked bytes, at most about ``most``; none at the end."""
        while True:
            if self._row["method"] == _DEFLATED and self._unpack.unconsumed_tail:
                out = self._unpack.decompress(self._unpack.unconsumed_tail, most)
            elif self._row["method"] == _BZIP2 and not self._unpack.needs_input and not self._unpack.eof:
                out = self._unpack.decompress(b"", most)
            elif not self._left:
                return b""
            else:
                raw = self._file.read_at(min(CHUNK_BYTES, self._left), self._at)
                if not raw:
                    raise ValueError(f"{self._row['entry']} is cut off")
                self._at, self._left = self._at + len(raw), self._left - len(raw)
                out = raw if self._unpack is None else self._unpack.decompress(raw, most)
            if out:
                return out

    def readinto(self, buffer):
        if not self._ready:
            self._ready = self._more(CHUNK_BYTES)
            if not self._ready:
                if self._crc != self._row["crc"] or self._given != self._row["bytes"]:
                    raise ValueError(f"{self._row['entry']}: size or CRC is wrong")
                return 0
            self._crc, self._given = zlib.crc32(self._ready, self._crc), self._given + len(self._ready)
        part = self._ready[:len(buffer)]
        buffer[:len(part)] = part
        self._ready = self._ready[len(part):]
        return len(part)


def _chunks(stream, chunk_bytes):
    """The stream in pieces of UTF-8, without byte order mark; a mark of UTF-16 is honoured."""
    chunk = stream.read(chunk_bytes)
    while len(chunk) < len(_UTF8_BOM) and (more := stream.read(chunk_bytes)):
        chunk += more
    if chunk.startswith(_UTF16_BOMS):
        stream.seek(0)
        wide = io.BufferedReader(stream) if isinstance(stream, io.RawIOBase) else stream
        text = io.TextIOWrapper(wide, encoding="utf-16", errors="replace", newline="")
        while part := text.read(chunk_bytes):
            yield part.encode("utf-8")
        return
    chunk = chunk.removeprefix(_UTF8_BOM) or stream.read(chunk_bytes)
    while chunk:
        yield chunk
        chunk = stream.read(chunk_bytes)


def line_blocks(stream, chunk_bytes=CHUNK_BYTES):
    """Lists of whole lines (bytes), broken at LF, CR or CRLF, from a stream read bit by bit."""
    held = []
    for chunk in _chunks(stream, chunk_bytes):
        # A CR that ends the chunk may be half of a CRLF, so it waits for the next chunk.
        cut = max(chunk.rfind(b"\n"), chunk.rfind(b"\r", 0, -1)) + 1
        if cut:
            yield b"".join([*held, chunk[:cut]]).splitlines()
            held = []
        held.append(chunk[cut:])
    rest = b"".join(held)
    if rest:
        yield rest.splitlines()


def to_text(lines):
    """Arrow strings of byte lines; bytes that are not UTF-8 become U+FFFD."""
    raw = pa.array(lines, pa.binary())
    try:
        return raw.cast(pa.string())
    except pa.ArrowInvalid:
        return pa.array([line.decode("utf-8", "replace") for line in lines], pa.string())


def _batch(columns):
    return pa.RecordBatch.from_arrays(list(columns.values()), names=list(columns))


NUMBERS = ("bytes", "packed_bytes", "start", "method", "flags", "crc")


def entry_rows(batches):
    """Entries of the archives named in the batches, folders left out."""

    def batch_of(uri, part):
        columns = {
            "archive": pa.array([uri] * len(part), pa.string()),
            "entry_no": pa.array([i for i, _ in part], pa.int64()),
            "entry": pa.array([e["entry"] for _, e in part], pa.string()),
        }
        for column in NUMBERS:
            columns[column] = pa.array([e[column] for _, e in part], pa.int64())
        return _batch(columns)

    for batch in batches:
        for uri in batch.column("archive").to_pylist():
            store, path = open_store(uri)
            part = []
            with store.open_input_file(path) as file:
                for i, entry in enumerate(entries_of(file)):
                    if entry["entry"].endswith("/"):
                        continue
                    part.append((i, entry))
                    if len(part) == BATCH_LINES:
                        yield batch_of(uri, part)
                        part = []
            if part:
                yield batch_of(uri, part)


def line_rows(batches):
    """Lines of the entries described in the batches, numbered from 1 in each entry."""
    opened, file = None, None
    try:
        for batch in batches:
            for row in batch.to_pylist():
                if row["archive"] != opened:
                    if file is not None:
                        file.close()
                    opened = row["archive"]
                    store, path = open_store(opened)
                    file = store.open_input_file(path)
                done = 0
                for block in line_blocks(EntryStream(file, row)):
                    for at in range(0, len(block), BATCH_LINES):
                        part = block[at:at + BATCH_LINES]
                        n = len(part)
                        yield _batch(
                            {
                                "archive": pa.array([opened] * n, pa.string()),
                                "entry_no": pa.array([row["entry_no"]] * n, pa.int64()),
                                "entry": pa.array([row["entry"]] * n, pa.string()),
                                "line_no": pa.array(range(done + 1, done + n + 1), pa.int64()),
                                "line": to_text(part),
                            }
                        )
                        done += n
    finally:
        if file is not None:
            file.close()
