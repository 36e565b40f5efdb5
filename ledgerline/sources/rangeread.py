"""Task-side helpers: listing folders and reading byte ranges of text files. They know nothing of Spark.

A range gives the lines that begin in it: it starts at the first line start at or after its first byte,
and goes on to the end of the line that holds its last byte. Both places depend on the file alone, so
neighbouring ranges neither share nor lose a line. Lines end at LF, CR or CRLF.
"""

import codecs
import re

import numpy as np
import pyarrow as pa
from pyarrow import fs

from ledgerline.sources.zipstream import open_store

CHUNK = 8 << 20
LOOK = 64 << 10
#: Rows of a listing, ranges, and bytes of lines of small files that a task holds at a time.
LISTED_ROWS = 8192
SLICE_ROWS = 256
GATHER_BYTES = 1 << 20

_MARKS = {
    "utf-8": [(codecs.BOM_UTF8, "utf-8")],
    "utf-16": [(codecs.BOM_UTF16_LE, "utf-16-le"), (codecs.BOM_UTF16_BE, "utf-16-be")],
    "utf-32": [(codecs.BOM_UTF32_LE, "utf-32-le"), (codecs.BOM_UTF32_BE, "utf-32-be")],
}
_DTYPES = {"utf-16-le": "<u2", "utf-16-be": ">u2", "utf-32-le": "<u4", "utf-32-be": ">u4"}
# Endings of packed files, which can only be read from their start.
PACKED = {".gz": "gzip", ".bz2": "bz2", ".zst": "zstd"}


def hidden_from_spark(name):
    """Whether a file scan of Spark leaves the name out."""
    return name.startswith(".") or (name.startswith("_") and "=" not in name) or name.endswith("._COPYING_")


def folder_rows(batches, wanted, files, folders, dots):
    """What the folders of the rows (path, odd) hold: path, name, bytes, folder, odd.

    ``wanted`` is a pattern for names; names with a dot in front need ``dots``. ``folders`` is "none",
    "wanted" or "all". Odd is what Spark would not read because of its name or that of a folder.
    """
    matches = re.compile(wanted, re.DOTALL).fullmatch
    out = []
    for batch in batches:
        for uri, odd in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            store, path = open_store(uri)
            if store.get_file_info(path).type != fs.FileType.Directory:
                continue
            infos = store.get_file_info(fs.FileSelector(path))
            while infos:  # each is let go when it is looked at, for a folder may hold very many
                info = infos.pop()
                name, is_folder = info.base_name, info.type == fs.FileType.Directory
                if not is_folder and (info.type != fs.FileType.File or not files):
                    continue
                fits = matches(name) and (dots or not name.startswith("."))
                if (folders == "none" or (folders == "wanted" and not fits)) if is_folder else not fits:
                    continue
                row = (f"{uri.rstrip('/')}/{name}", name, None if is_folder else info.size, is_folder)
                out.append((*row, odd or hidden_from_spark(name)))
                if len(out) == LISTED_ROWS:
                    yield _found(out)
                    out = []
    yield _found(out)


def _found(rows):
    columns = list(zip(*rows, strict=True)) or [()] * 5
    types = (pa.string(), pa.string(), pa.int64(), pa.bool_(), pa.bool_())
    return pa.RecordBatch.from_arrays(
        [pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=["path", "name", "bytes", "folder", "odd"]
    )


class Units:
    """The code units of an encoding: their width, and where lines end in them."""

    def __init__(self, encoding, head):
        name = codecs.lookup(encoding).name
        self.encoding, self.first = name, 0
        for mark, exact in _MARKS.get(name, []):
            if head.startswith(mark):
                self.encoding, self.first = exact, len(mark)
        if self.encoding in ("utf-16", "utf-32"):  # no mark: taken as little-endian
            self.encoding += "-le"
        self.dtype = np.dtype(_DTYPES.get(self.encoding, "u1"))
        self.width = self.dtype.itemsize
        ends = [int.from_bytes(c.encode(self.encoding), "big") for c in "\n\r"]
        if self.width == 1 and max(ends) > 255:
            raise ValueError(f"lines of {encoding} files cannot be told by single bytes")
        self.feed, self.carriage = (10, 13) if self.width > 1 else ends

    def ends(self, data, final):
        """Offsets just after every line end; a CR as last unit is left open unless it is the last of all."""
        units = np.frombuffer(data[: len(data) // self.width * self.width], self.dtype)
        feed = units == self.feed
        back = units == self.carriage
        if back.any():
            feed = feed | (back & ~np.r_[feed[1:], not final])
        return (np.flatnonzero(feed) + 1) * self.width

    def text(self, data):
        """The data as UTF-8."""
        if self.encoding == "utf-8":
            return data
        return data.decode(self.encoding, "replace").encode("utf-8")

    def open_return(self, data):
        return data[-self.width :] == "\r".encode(self.encoding)

    def begins_with_feed(self, data):
        return data[: self.width] == "\n".encode(self.encoding)


def line_start(file, units, place, size):
    """The first line start at or after a place."""
    if place <= units.first:
        return units.first
    base, data, step = place - units.width, b"", LOOK
    while place < size:
        at = base + len(data)
        data += file.read_at(min(step, size - at), at)
        final = base + len(data) >= size
        ends = units.ends(data, final) + base
        ends = ends[ends >= place]
        if len(ends):
            return int(ends[0])
        if final:
            break
        base, data, step = base + len(data) - units.width, data[-units.width :], CHUNK
    return size


def _whole_lines(pieces, units):
    """Pieces of a text cut at line ends; the last one may end without."""
    held = []
    for data in pieces:
        if held and units.open_return(held[-1]) and not units.begins_with_feed(data):
            yield b"".join(held)
            held = []
        ends = units.ends(data, False)
        if len(ends):
            cut = int(ends[-1])
            yield b"".join([*held, data[:cut]])
            held, data = [], data[cut:]
        if data:
            held.append(data)
    if held:
        yield b"".join(held)


def _pieces(read, length):
    """Pieces of a stream up to ``length`` bytes, or to its end."""
    while length is None or length > 0:
        data = read(CHUNK if length is None else min(CHUNK, length))
        if not data:
            if length is None:
                return
            raise ValueError("a file is shorter than when it was listed")
        if length is not None:
            length -= len(data)
        yield data


def range_texts(row, encoding):
    """UTF-8 pieces of whole lines of one range."""
    store, path = open_store(row["f"])
    if row["packed"]:
        packing = next(p for ending, p in PACKED.items() if path.lower().endswith(ending))
        with store.open_input_stream(path, compression=packing) as stream:
            head = stream.read(4)
            units = Units(encoding, head)

            def read(n, left=[head[units.first :]]):  # noqa: B006
                return left.pop() + stream.read(n) if left else stream.read(n)

            yield from map(units.text, _whole_lines(_pieces(read, None), units))
        return
    with store.open_input_file(path) as file:
        size = row["bytes"]
        units = Units(encoding, file.read_at(4, 0))
        first, last = (line_start(file, units, p, size) for p in (row["start"], row["end"]))
        file.seek(first)
        yield from map(units.text, _whole_lines(_pieces(file.read, max(0, last - first)), units))


def _breaks(data, wide):
    """Places of the last bytes of line ends, and of all bytes of line ends."""
    b = np.frombuffer(data, np.uint8)
    feed, back = b == 0x0A, b == 0x0D
    end, gone = feed, feed
    if back.any():
        end = feed | (back & ~np.r_[feed[1:], False])
        gone = feed | back
    if wide:
        single = (b == 0x0B) | (b == 0x0C) | ((b >= 0x1C) & (b <= 0x1E))
        end, gone = end | single, gone | single
        next_line = np.flatnonzero((b[:-1] == 0xC2) & (b[1:] == 0x85))
        wider = np.flatnonzero((b[:-2] == 0xE2) & (b[1:-1] == 0x80) & ((b[2:] == 0xA8) | (b[2:] == 0xA9)))
        for at, length in ((next_line, 2), (wider, 3)):
            end[at + length - 1] = True
            for i in range(length):
                gone[at + i] = True
    return np.flatnonzero(end), gone


def count_lines(data, wide):
    end, _ = _breaks(data, wide)
    return len(end) + int(not len(end) or end[-1] < len(data) - 1)


def split_lines(data, wide):
    """The lines of a piece as an Arrow array, without an object per line."""
    end, gone = _breaks(data, wide)
    removed = np.flatnonzero(gone)
    stops = end + 1 - np.searchsorted(removed, end, "right")
    kept = np.frombuffer(data, np.uint8)[~gone]
    if not len(end) or end[-1] < len(data) - 1:
        stops = np.r_[stops, len(kept)]
    if len(kept) >= 1 << 31:
        raise ValueError("a line is too long for a text")
    offsets = np.r_[0, stops].astype(np.int32)
    return pa.StringArray.from_buffers(len(stops), pa.py_buffer(offsets.tobytes()), pa.py_buffer(kept.tobytes()))


def _rows_of(batches):
    """The rows as dicts, a few of them at a time."""
    for batch in batches:
        for at in range(0, batch.num_rows, SLICE_ROWS):
            yield from batch.slice(at, SLICE_ROWS).to_pylist()


def _gathered(batches):
    """Small batches put together, so that one of few lines does not travel alone."""
    held, size = [], 0
    for batch in batches:
        held.append(batch)
        size += batch.nbytes
        if size >= GATHER_BYTES:
            yield from _joined(held)
            held, size = [], 0
    if held:
        yield from _joined(held)


def _joined(held):
    if len(held) == 1:
        return held
    return pa.Table.from_batches(held).combine_chunks().to_batches()


def line_rows(batches, encoding, wide, numbered):
    """Lines of the ranges: src, block, pos, line; numbered ones also with line_no and src_lines."""
    return _gathered(_line_rows(batches, encoding, wide, numbered))


def _line_rows(batches, encoding, wide, numbered):
    for row in _rows_of(batches):
        n = 0
        for data in range_texts(row, encoding):
            lines = split_lines(data, wide)
            count = len(lines)
            pos = np.arange(n, n + count)
            columns = {
                "src": pa.repeat(pa.scalar(row["src"], pa.string()), count),
                "block": pa.array(np.full(count, row["start"])),
                "pos": pa.array(pos),
                "line": lines,
            }
            if numbered:
                columns["line_no"] = pa.array(row["offset"] + pos + 1)
                columns["src_lines"] = pa.array(np.full(count, row["src_lines"]))
            yield pa.RecordBatch.from_pydict(columns)
            n += count
        if numbered and n != row["n"]:
            raise ValueError(f"{row['f']} changed between two passes")


def count_rows(batches, encoding, wide):
    """The ranges with n, the number of their lines."""
    for batch in batches:
        counts = [sum(count_lines(d, wide) for d in range_texts(row, encoding)) for row in _rows_of([batch])]
        yield pa.RecordBatch.from_arrays(
            [*batch.columns, pa.array(counts, pa.int64())], names=[*batch.schema.names, "n"]
        )


def ended_rows(batches, encoding):
    """Whether the last line of each file (src, f, bytes) has a line end: src, ended."""
    for batch in batches:
        ended = []
        for row in _rows_of([batch]):
            store, path = open_store(row["f"])
            with store.open_input_file(path) as file:
                units = Units(encoding, file.read_at(4, 0))
                last = file.read_at(units.width, max(0, row["bytes"] - units.width))
            ended.append(bool(len(units.ends(last, True))))
        yield pa.RecordBatch.from_arrays([batch.column("src"), pa.array(ended, pa.bool_())], names=["src", "ended"])
