"""Small task-side helpers that write texts as files or into ZIP archives. They know nothing of Spark."""

import posixpath
import zipfile

import pyarrow as pa

from ledgerline.sources.zipstream import open_store


SLICE_ROWS = 64


def _open(uri):
    store, path = open_store(uri)
    store.create_dir(posixpath.dirname(path), recursive=True)
    return zipfile.ZipFile(store.open_output_stream(path), "w", zipfile.ZIP_DEFLATED)


def write_rows(batches):
    """Write rows of file and text as files; yields their names. A few texts at a time are Python's."""
    known = set()
    for batch in batches:
        for at in range(0, batch.num_rows, SLICE_ROWS):
            part = batch.slice(at, SLICE_ROWS)
            for uri, text in zip(*(c.to_pylist() for c in part.columns), strict=True):
                store, path = open_store(uri)
                if posixpath.dirname(path) not in known:
                    store.create_dir(posixpath.dirname(path), recursive=True)
                    known.add(posixpath.dirname(path))
                with store.open_output_stream(path) as out:
                    out.write(text.encode("utf-8"))
            yield pa.RecordBatch.from_arrays([part.column(0)], names=["file"])


def write_lines(batches, encoding):
    """Write rows of file and line, sorted by file, as files of lines with a byte order mark; yields their names."""
    out, opened = None, None
    for batch in batches:
        for uri, line in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if uri != opened:
                if out is not None:
                    out.close()
                store, path = open_store(uri)
                store.create_dir(posixpath.dirname(path), recursive=True)
                out, opened = store.open_output_stream(path), uri
                out.write("\ufeff".encode(encoding))
                yield pa.RecordBatch.from_arrays([pa.array([uri])], names=["file"])
            out.write((line + "\n").encode(encoding))
    if out is not None:
        out.close()


def pack_rows(batches):
    """Write rows of archive, folder, name, text, sorted by archive; yields the archive names.

    A task that is run again writes the same archives again.
    """
    opened, archive, folders = None, None, set()
    for batch in batches:
        for row in batch.to_pylist():
            if row["archive"] != opened:
                if archive is not None:
                    archive.close()
                archive, opened, folders = _open(row["archive"]), row["archive"], set()
                yield pa.RecordBatch.from_arrays([pa.array([opened])], names=["archive"])
            if row["folder"] not in folders:
                archive.writestr(row["folder"] + "/", b"")
                folders.add(row["folder"])
            archive.writestr(f"{row['folder']}/{row['name']}", row["text"].encode("utf-8"))
    if archive is not None:
        archive.close()
