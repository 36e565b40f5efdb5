"""Removal of byte strings that also start earlier, by sorting sampled suffixes at growing offsets.

A byte goes if it lies in a string of ``length`` bytes that also starts earlier in the corpus. Equal
strings are found by naming: Spark sorts rows (name of the first part, name of the part at the next
offset, position), so equal strings lie together in the order of their positions; a position whose first
part is unique goes no further. With half = length / 2, rounded up, the offsets are 0 and length - half,
and the second sort is past the threshold.

*Sampled positions.* In every window of ``length`` bytes the smallest hash of a half-length string marks
one place, by content alone, so equal windows mark the same place. Windows that follow each other and
mark the same place form one interval, and only intervals are sorted at first: by the name of the string
at the marked place, then by the name of all bytes their windows cover. A row that is not the first of
its pair is settled: all its windows start earlier as well. A first row whose marked string occurs in no
other first row has no equal window anywhere. The rest is open.

*Open windows* are sorted one by one, by the names at offset 0 and at length - half; all but the first of
equal ones are repeated. An equal earlier window of an open one is open or has a still earlier open one,
so nothing is lost.

Names are 64-bit hashes of bytes and are only compared in pairs, so a string is told by 128 bits.

Runs of equal rows are cut anywhere by the range sort, positions included, so a hot string spreads over
tasks. What a task cannot know about the runs at its two ends is settled from a summary of two rows per
task.

Documents are ordered by id, nulls first; rows that share an id by a hash of the text; equal rows are one
document, and each of them gets its result. A null or empty text has no bytes. An empty table gives an
empty result. Other columns are ignored, or passed on by ``dedup``.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.llm.common import Staged, Substrings, ddl, documents, in_slices, join_measured, placed, stage

LENGTH = 100

#: Bytes that are hashed together; a longer text is cut into overlapping segments of this many windows.
SEGMENT = 1 << 18
_PLACE_BITS = 20
_PLACES = np.uint64((1 << _PLACE_BITS) - 1)
_NO_ID = -(2**63)

_ROWS = "r1 bigint, r2 bigint, pos bigint"
_FOUND = "kind int, pos bigint, part int, r1 bigint, r2 bigint, runs bigint, head boolean"
FIRST, SETTLED, RUN_AT_START, RUN_AT_END = 1, 2, 3, 4


class Places:
    """How a position is packed in one number that sorts: document, offset, windows less one."""

    def __init__(self, documents: int, longest: int, length: int):
        self.n_bits = (length // 2 + 1).bit_length()
        self.at_bits = max(1, longest.bit_length())
        if max(1, documents.bit_length()) + self.at_bits + self.n_bits > 63:
            raise ValueError("documents times the longest text leave 63 bits")
        self.doc_bits = self.at_bits + self.n_bits

    def pack(self, doc, at, n):
        return (doc << self.doc_bits) | (at << self.n_bits) | (n - 1)

    def doc(self, pos):
        return F.shiftright(pos, self.doc_bits)

    def rest(self, pos):
        return pos.bitwiseAND(F.lit((1 << self.doc_bits) - 1))


def _key(docs: DataFrame, id_column: str):
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    return F.coalesce(F.col(f"`{id_column}`").cast("long"), F.lit(_NO_ID)), F.xxhash64(text), text.cast("binary")


def numbered(docs: DataFrame, length: int = LENGTH, id_column: str = "doc_id") -> tuple[Staged, Places]:
    """id, tid, doc: number of every different document in the order of documents."""
    key, tid, text = _key(docs, id_column)
    narrow = docs.select(key.alias("id"), tid.alias("tid"), F.octet_length(text).alias("size"))
    narrow = narrow.groupBy("id", "tid").agg(F.max("size").alias("size"))
    rows, staged = placed(narrow, [F.col("id"), F.col("tid")], "document-order", "doc")
    longest = staged.df.agg(F.max("size")).collect()[0][0] or 0
    return Staged(rows.select("id", "tid", "doc"), staged.rows, staged.bytes), Places(staged.rows, longest, length)


def _texts(docs: DataFrame, numbers: Staged, id_column: str = "doc_id") -> DataFrame:
    """doc and text (bytes) of every row, with ``own``: all its columns."""
    key, tid, text = _key(docs, id_column)
    own = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("own")
    rows = docs.select(own, key.alias("id"), tid.alias("tid"), text.alias("text"))
    return join_measured(rows, numbers, ["id", "tid"]).select("doc", "text", "own")


def _segments(
    docs: Iterable[int], texts: Iterable[bytes], length: int, segment: int
) -> Iterator[list[tuple[int, int, bytes]]]:
    """Groups of (doc, offset, bytes) of bounded size; windows of a long text are dealt over segments."""
    held, size = [], 0
    for doc, text in zip(docs, texts, strict=True):
        for at in range(0, len(text) - length + 1, segment):
            part = text[at : at + segment + length - 1]
            if held and size + len(part) > segment + length:
                yield held
                held, size = [], 0
            held.append((doc, at, part))
            size += len(part)
    if held:
        yield held


def _smallest(names: np.ndarray, width: int) -> np.ndarray:
    """Place of the smallest name (the last of equal ones) in every ``width`` places in a row."""
    places = np.arange(len(names), dtype=np.uint64)
    v = (names & ~_PLACES) | (_PLACES - places)
    size = 1
    while size < width:
        step = min(size, width - size)
        v = np.minimum(v[:-step], v[step:])
        size += step
    return (_PLACES - (v & _PLACES)).astype(np.int64)


def _spread(group: list[tuple[int, int, bytes]]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """All bytes of a group, and of every byte: its document, its offset, and the end of its segment."""
    sizes = np.array([len(p) for _, _, p in group])
    ends = np.cumsum(sizes)
    starts = ends - sizes
    doc = np.repeat(np.array([d for d, _, _ in group], np.int64), sizes)
    shift = np.repeat(np.array([a for _, a, _ in group], np.int64) - starts, sizes)
    codes = np.frombuffer(b"".join([p for _, _, p in group]), np.uint8)
    return codes, doc, np.arange(len(codes)) + shift, np.repeat(ends, sizes)


def intervals(texts: DataFrame, places: Places, length: int = LENGTH, segment: int = SEGMENT) -> DataFrame:
    """r1, r2, pos of all intervals of windows that mark the same place, once per document and task."""
    half = (length + 1) // 2

    def make():
        runs, seen = Substrings(), set()

        def work(rows):
            out = ([], [], [])
            new = [(d, t) for d, t in zip(rows["doc"], rows["text"], strict=True) if d not in seen and not seen.add(d)]
            for group in _segments([d for d, _ in new], [t for _, t in new], length, segment):
                codes, doc, offset, end = _spread(group)
                runs.load(codes)
                names = runs.every(half)
                marked = _smallest(names, length - half + 1)
                inside = np.arange(len(marked)) + length <= end[: len(marked)]
                change = np.r_[True, (marked[1:] != marked[:-1]) | (inside[1:] != inside[:-1])]
                change[1:] |= end[1 : len(marked)] != end[: len(marked) - 1]
                first = np.flatnonzero(change)
                n = np.diff(np.r_[first, len(marked)])
                first, n = first[inside[first]], n[inside[first]]
                mark = marked[first]
                covered = runs.of(first, first + n - 1 + length)
                layout = ((mark - first) * 4096 + n).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
                out[0].append(names[mark])
                out[1].append(covered ^ layout)
                out[2].append(places.pack(doc[first], offset[first], n))
            return _columns(out)

        return work

    return in_slices(texts.select("doc", "text"), make, _ROWS)


def _columns(out) -> dict[str, np.ndarray]:
    r1, r2, pos = (np.concatenate(c) if c else np.empty(0, np.int64) for c in out)
    return {"r1": r1.view(np.int64), "r2": r2.view(np.int64), "pos": pos.astype(np.int64)}


def open_windows(texts: DataFrame, places: Places, length: int = LENGTH, segment: int = SEGMENT) -> DataFrame:
    """r1, r2, pos of every single window in the packed open intervals ``runs`` of a document."""
    half = (length + 1) // 2
    second = length - half

    def make():
        hashes, seen = Substrings(), set()

        def work(rows):
            out = ([], [], [])
            for doc, text, packed in zip(rows["doc"], rows["text"], rows["runs"], strict=True):
                if doc in seen:
                    continue
                seen.add(doc)
                at, n = unpack(packed, places.n_bits)
                for low in range(0, len(text) - length + 1, segment):
                    here = (at >= low) & (at < low + segment)
                    if not here.any():
                        continue
                    hashes.load(np.frombuffer(text[low : low + segment + length - 1], np.uint8))
                    count = n[here]
                    start = np.repeat(at[here] - low - np.r_[0, np.cumsum(count)[:-1]], count) + np.arange(count.sum())
                    out[0].append(hashes.of(start, start + half))
                    out[1].append(hashes.of(start + second, start + length))
                    out[2].append(places.pack(np.int64(doc), start + low, 1))
            return _columns(out)

        return work

    return in_slices(texts.select("doc", "text", "runs"), make, _ROWS)


def _found(part: int, kind: int, pos, r1=None, r2=None, runs=None, head=None) -> pa.RecordBatch:
    size = len(pos)

    def column(values, kind_of):
        return pa.nulls(size, kind_of) if values is None else pa.array(values, kind_of)

    return pa.RecordBatch.from_pydict(
        {
            "kind": pa.array([kind] * size, pa.int32()),
            "pos": pa.array(pos, pa.int64()),
            "part": pa.array([part] * size, pa.int32()),
            "r1": column(r1, pa.int64()),
            "r2": column(r2, pa.int64()),
            "runs": column(runs, pa.int64()),
            "head": column(head, pa.bool_()),
        }
    )


def _judged(batches: Iterator[pa.RecordBatch], firsts: bool) -> Iterator[pa.RecordBatch]:
    """From rows sorted by r1, r2, pos: settled ones, open first ones, and a summary of both ends.

    A run is all rows of one r1, and its first rows are those with a new r2. They are open if the run has
    several; first rows of the task's first run, and the only one of its last run, are passed on with r1
    for the summary to decide. Without ``firsts`` only the task's first row is passed on.
    """
    part = TaskContext.get().partitionId()
    last = start = before = None
    edge, count, start_count, held = True, 0, 0, np.empty(0, np.int64)
    for batch in batches:
        r1, r2, pos = (batch.column(i).to_numpy() for i in range(3))
        if not len(pos):
            continue
        # Equal rows are one document that came from several tasks, and lie in one task here.
        new = np.r_[before != (r1[0], r2[0], pos[0]), (pos[1:] != pos[:-1]) | (r1[1:] != r1[:-1]) | (r2[1:] != r2[:-1])]
        before = (r1[-1], r2[-1], pos[-1])
        r1, r2, pos = r1[new], r2[new], pos[new]
        if not len(pos):
            continue
        new_run = np.r_[last is not None and last[0] != r1[0], r1[1:] != r1[:-1]]
        first = new_run | np.r_[last is None or last[1] != r2[0], r2[1:] != r2[:-1]]
        yield _found(part, SETTLED, pos[~first])
        head = np.zeros(int(first.sum()), bool)
        if last is None:
            start, head[0] = (int(r1[0]), int(r2[0])), True
            if not firsts:
                yield _found(part, FIRST, pos[:1], r1[:1], head=[True])
        last = (int(r1[-1]), int(r2[-1]))
        if not firsts:
            continue
        run = np.cumsum(new_run)  # 0: the run of the batch before
        final = int(run[-1])
        f_pos, f_run, f_r1 = pos[first], run[first], r1[first]
        sizes = np.bincount(f_run, minlength=final + 1)
        going = f_run == 0
        count += int(sizes[0])
        if edge:
            yield _found(part, FIRST, f_pos[going], f_r1[going], head=head[going])
            start_count = count
        else:
            held = np.r_[held, f_pos[going]]
            if count > 1:
                yield _found(part, FIRST, held)
                held = held[:0]
        if final:
            yield _found(part, FIRST, f_pos[(f_run > 0) & (f_run < final) & (sizes[f_run] > 1)])
            edge, count, held = False, int(sizes[final]), f_pos[f_run == final]
            if count > 1:
                yield _found(part, FIRST, held)
                held = held[:0]
    if last is not None:
        if len(held):
            yield _found(part, FIRST, held, [last[0]], head=[False])
        yield _found(part, RUN_AT_START, [0], [start[0]], [start[1]], [start_count])
        yield _found(part, RUN_AT_END, [0], [last[0]], [last[1]], [count])


def sorted_names(pairs: DataFrame, name: str, firsts: bool) -> tuple[DataFrame, DataFrame]:
    """Of rows r1, r2, pos: positions that are settled, and with ``firsts`` those that are first but open."""
    order = pairs.repartitionByRange("r1", "r2", "pos").sortWithinPartitions("r1", "r2", "pos")
    found = stage(order.mapInArrow(lambda batches: _judged(batches, firsts), _FOUND), name).df
    ends: dict[int, dict[int, tuple[int, int, int]]] = {}
    for r in found.filter(F.col("kind") >= RUN_AT_START).collect():  # two rows per task
        ends.setdefault(r["part"], {})[r["kind"]] = (r["r1"], r["r2"], r["runs"])
    total: dict[int, int] = {}  # first rows of the runs at task ends, over all tasks
    heads, before = [], None  # tasks whose first row is not the first of its pair
    for part in sorted(ends):
        start, end = ends[part][RUN_AT_START], ends[part][RUN_AT_END]
        total[start[0]] = total.get(start[0], 0) + start[2]
        if end[0] != start[0]:
            total[end[0]] = total.get(end[0], 0) + end[2]
        if before == start[:2]:
            heads.append(part)
            total[start[0]] -= 1
        before = end[:2]
    facts = pairs.sparkSession.createDataFrame([(r1, n > 1) for r1, n in total.items()], "r1 bigint, several boolean")
    first = found.filter(F.col("kind") == FIRST)
    known = first.filter(F.col("r1").isNull()).select("pos")
    edges = first.filter(F.col("r1").isNotNull()).join(F.broadcast(facts), "r1")
    late = F.col("head") & F.col("part").isin(heads)
    settled = found.filter(F.col("kind") == SETTLED).select("pos").unionByName(edges.filter(late).select("pos"))
    return settled, known.unionByName(edges.filter(~late & F.col("several")).select("pos"))


def pack(values: list[int]) -> bytes:
    ordered = np.sort(np.array(values, np.int64))
    return zlib.compress(np.diff(ordered, prepend=np.int64(0)).tobytes(), 1)


def unpack(packed: bytes, n_bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Offsets and numbers of windows."""
    values = np.cumsum(np.frombuffer(zlib.decompress(packed), np.int64))
    return values >> n_bits, (values & ((1 << n_bits) - 1)) + 1


def by_document(positions: DataFrame, places: Places, name: str) -> Staged:
    """doc, runs: the positions of every document that has any, packed."""
    pos = F.col("pos")
    gathered = positions.select(places.doc(pos).alias("doc"), places.rest(pos).alias("at"))
    gathered = gathered.groupBy("doc").agg(F.collect_list("at").alias("at"))
    packed = in_slices(gathered, lambda: lambda rows: {"runs": [pack(a) for a in rows["at"]]}, "doc bigint, runs binary")
    return stage(packed, name)


def repeated_runs(
    docs: DataFrame, length: int = LENGTH, id_column: str = "doc_id", segment: int = SEGMENT
) -> tuple[DataFrame, Staged, Places]:
    """doc, text, own of all rows; and the packed runs of windows that start earlier as well, by doc."""
    numbers, places = numbered(docs, length, id_column)
    texts = _texts(docs, numbers, id_column)
    settled, undecided = sorted_names(intervals(texts, places, length, segment), "interval-names", firsts=True)
    undecided = by_document(undecided, places, "open-intervals")
    asked = join_measured(texts, undecided, ["doc"])
    repeated, _ = sorted_names(open_windows(asked, places, length, segment), "window-names", firsts=False)
    return texts, by_document(settled.unionByName(repeated), places, "repeated-windows"), places


def spans(at: np.ndarray, n: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the maximal runs of bytes that the windows cover; runs are in order."""
    ends = np.maximum.accumulate(at + n - 1 + length)
    new = np.flatnonzero(np.r_[True, at[1:] > ends[:-1]])
    return at[new], ends[np.r_[new[1:] - 1, len(at) - 1]]


def _cut(text: bytes, packed: bytes | None, n_bits: int, length: int) -> tuple[bytes, int, int]:
    """What stays, removed bytes, removed spans."""
    if packed is None:
        return text, 0, 0
    starts, ends = spans(*unpack(packed, n_bits), length)
    edges = zip([0, *ends.tolist()], [*starts.tolist(), len(text)], strict=True)
    return b"".join([text[a:b] for a, b in edges]), int((ends - starts).sum()), len(starts)


def with_kept(docs: DataFrame, length: int = LENGTH, id_column: str = "doc_id", segment: int = SEGMENT) -> DataFrame:
    """own (all columns), kept (the bytes that stay), n_bytes, n_removed, n_spans of every row."""
    texts, runs, places = repeated_runs(docs, length, id_column, segment)
    n_bits = places.n_bits

    def make():
        def work(rows):
            done = [_cut(t, p, n_bits, length) for t, p in zip(rows["text"], rows["runs"], strict=True)]
            return {
                "kept": [d[0] for d in done],
                "n_bytes": [len(t) for t in rows["text"]],
                "n_removed": [d[1] for d in done],
                "n_spans": [d[2] for d in done],
            }

        return work

    joined = join_measured(texts, runs, ["doc"], "left").select("own", "text", "runs")
    schema = f"{ddl(joined, ['own'])}, kept binary, n_bytes bigint, n_removed bigint, n_spans bigint"
    return in_slices(joined, make, schema, use=["text", "runs"])


def dedup(docs: DataFrame, length: int = LENGTH, id_column: str = "doc_id") -> DataFrame:
    """The documents without the bytes that also start earlier; a character cut in part goes as a whole."""
    own, kept = docs.columns, with_kept(docs, length, id_column)

    def make():
        return lambda rows: {"text": [k.decode("utf-8", "ignore") for k in rows["kept"]]}

    changed = kept.filter("n_removed > 0").select("own", "kept")
    cut = in_slices(changed, make, f"{ddl(changed, ['own'])}, text string", use=["kept"])
    new = [F.col("text") if c == "text" else F.col("own").getField(c).alias(c) for c in own]
    same = kept.filter("n_removed = 0").select([F.col("own").getField(c).alias(c) for c in own])
    return same.unionByName(cut.select(new))


def op13_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = with_kept(documents(spark, sf_dir).select("doc_id", "text"))
    return kept.select("own.doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


OP13_SQL = """
WITH d AS (
  SELECT doc_id, lower(hex(encode(coalesce(text, '')))) AS h FROM documents
), parts AS (
  SELECT doc_id, o, substr(h, 2 * o + 1, 2 * (400 + 99)) AS part FROM d, unnest(range(0, len(h) // 2 - 99, 400)) AS u(o)
), w AS (
  SELECT doc_id, o + j AS i, md5(substr(part, 2 * j + 1, 200)) AS m FROM parts, unnest(range(0, len(part) // 2 - 99)) AS u(j)
), f AS (
  SELECT doc_id, i FROM (SELECT *, row_number() OVER (PARTITION BY m ORDER BY doc_id, i) AS r FROM w) WHERE r > 1
), g AS (
  SELECT *, sum(CASE WHEN i > before + 100 THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id ORDER BY i) AS span
  FROM (SELECT *, lag(i) OVER (PARTITION BY doc_id ORDER BY i) AS before FROM f)
), s AS (
  SELECT doc_id, span, min(i) AS a, max(i) + 100 AS b FROM g GROUP BY ALL
), gaps AS (
  SELECT doc_id, a, b, lag(b, 1, 0) OVER (PARTITION BY doc_id ORDER BY a) AS past FROM s
), cut AS (
  SELECT doc_id, count(*) AS n_spans, sum(b - a) AS n_removed, max(b) AS tail,
    string_agg(substr(h, 2 * past + 1, 2 * (a - past)), '' ORDER BY a) AS kept
  FROM gaps JOIN d USING (doc_id) GROUP BY doc_id
)
SELECT doc_id, CAST(len(h) // 2 AS BIGINT) AS n_bytes, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed,
  CAST(coalesce(n_spans, 0) AS BIGINT) AS n_spans,
  sha256(unhex(CASE WHEN n_spans IS NULL THEN h ELSE kept || substr(h, 2 * tail + 1) END)) AS kept_sha256
FROM d LEFT JOIN cut USING (doc_id)
"""
