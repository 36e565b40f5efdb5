"""Task-side helpers that write text files from blocks of lines. They know nothing of Spark."""

import posixpath
import uuid

import pyarrow as pa

from ledgerline.sources.zipstream import open_store

COPY_BYTES = 8 << 20
#: Blocks that a task reports at a time, and files that it holds the blocks of.
REPORT_ROWS = 4096
SLICE_ROWS = 256


def _folder_of(store, path):
    store.create_dir(posixpath.dirname(path), recursive=True)


def block_rows(batches, folder):
    """Write rows (file, block, line), sorted by file and block, one behind the other into one file per task:
    file, block, path, at, bytes."""
    out, path, key, at, size, done = None, None, None, 0, 0, []

    def rows():
        types = (pa.string(), pa.int64(), pa.string(), pa.int64(), pa.int64())
        columns = list(zip(*done, strict=True))
        done.clear()
        return pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=["file", "block", "path", "at", "bytes"]
        )

    for batch in batches:
        files, blocks, lines = (batch.column(i).to_pylist() for i in range(3))
        begin = 0
        while begin < len(files):
            end = begin + 1
            while end < len(files) and files[end] == files[begin] and blocks[end] == blocks[begin]:
                end += 1
            if key != (files[begin], blocks[begin]):
                if out is None:
                    path = f"{folder}/{uuid.uuid4().hex}"
                    store, place = open_store(path)
                    _folder_of(store, place)
                    out = store.open_output_stream(place)
                else:
                    done.append((*key, path, at, size))
                    if len(done) == REPORT_ROWS:
                        yield rows()
                key, at, size = (files[begin], blocks[begin]), at + size, 0
            data = ("\n".join(lines[begin:end]) + "\n").encode("utf-8")
            out.write(data)
            size += len(data)
            begin = end
    if out is not None:
        out.close()
        done.append((*key, path, at, size))
        yield rows()


class _Opened:
    """The file that was read last, kept open: blocks that follow each other often lie in one."""

    def __init__(self):
        self._path, self._file = None, None

    def __call__(self, path):
        if path != self._path:
            self.close()
            store, place = open_store(path)
            self._path, self._file = path, store.open_input_file(place)
        return self._file

    def close(self):
        if self._file is not None:
            self._file.close()


def file_rows(batches, folder):
    """Write files (file, cut, blocks) from their blocks in order, without the last byte if ``cut``: file, bytes.

    A file gets its name when it is complete, so a task that is run again writes it anew.
    """
    opened, known = _Opened(), set()
    for batch in batches:
        for start in range(0, batch.num_rows, SLICE_ROWS):
            part = batch.slice(start, SLICE_ROWS)
            sizes = []
            for row in part.to_pylist():
                store, path = open_store(f"{folder}/{row['file']}")
                if posixpath.dirname(path) not in known:
                    _folder_of(store, path)
                    known.add(posixpath.dirname(path))
                draft = posixpath.join(posixpath.dirname(path), f".{uuid.uuid4().hex}")
                total = sum(b["bytes"] for b in row["blocks"] or [])
                left = wanted = max(0, total - bool(row["cut"]))
                with store.open_output_stream(draft) as out:
                    for block in row["blocks"] or []:
                        data, at = opened(block["path"]), block["at"]
                        end = at + min(left, block["bytes"])
                        while at < end and (piece := data.read_at(min(COPY_BYTES, end - at), at)):
                            out.write(piece)
                            at, left = at + len(piece), left - len(piece)
                if left:
                    raise ValueError(f"blocks of {row['file']} are incomplete")
                store.move(draft, path)
                sizes.append(wanted)
            yield pa.RecordBatch.from_arrays([part.column("file"), pa.array(sizes, pa.int64())], names=["file", "bytes"])
    opened.close()


def removed_rows(batches):
    """Delete the files of column path."""
    for batch in batches:
        for uri in batch.column("path").to_pylist():
            store, path = open_store(uri)
            if store.get_file_info(path).is_file:
                store.delete_file(path)
        yield batch
