"""Line dedup over a corpus, with keep bitmaps instead of moved text.

Every line gets a 128-bit hash of its key (outer space stripped, A-Z lower-cased). Hashes are
range-partitioned and sorted by document, largest first, and position; a task streams each run of
equal hashes once, knows the first document, and drops the others' lines as soon as enough documents
were seen. The result is one compressed bitmap per document that loses lines; only that meets the
texts again.

A run is not cut by the partitioning unless its key is hot (over ``HOT_ROWS`` rows). Hot keys are
dealt over several ranges by document; their document count and holder come from an aggregate that
is combined map-side and ride along with the rows.

Defined cases: a null or empty text is one empty line. A null id is the smallest id; rows that share
an id are one document for the count, and all keep their lines if it is the holder. Repeated rows
get equal bitmaps. An empty table gives an empty result. Other columns are ignored by the bitmaps.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.llm.common import Staged, ddl, documents, in_slices, join_measured, stage

MIN_CHARS = 40
MIN_DOCS = 5
HOT_ROWS = 8192

_NO_ID = -(2**63)


def _identified(docs: DataFrame) -> DataFrame:
    """Id as a number that sorts, text as bytes, and a hash that tells texts of one id apart."""
    return docs.select(
        F.coalesce(F.col("doc_id").cast("long"), F.lit(_NO_ID)).alias("doc"),
        F.xxhash64(F.coalesce("text", F.lit(""))).alias("tid"),
        F.coalesce("text", F.lit("")).cast("binary").alias("text"),
    )


def _chars(key: bytes) -> int:
    return len(key) if key.isascii() else len(key.decode("utf-8", "replace"))


def line_keys(docs: DataFrame, min_chars: int = MIN_CHARS) -> DataFrame:
    """A row per line whose key is long enough: hash (h1, h2), doc, tid, position, lines of the text."""

    def make():
        def work(rows):
            out = {n: [] for n in ("h1", "h2", "doc", "tid", "pos", "n_lines")}
            for doc, tid, text in zip(rows["doc"], rows["tid"], rows["text"], strict=True):
                lines = text.split(b"\n")
                for pos, line in enumerate(lines):
                    if len(line) < min_chars:
                        continue
                    key = line.strip().lower()
                    if len(key) >= min_chars and _chars(key) >= min_chars:
                        h = xxhash.xxh3_128_intdigest(key)
                        out["h1"].append((h >> 64) - 2**63)
                        out["h2"].append((h & (2**64 - 1)) - 2**63)
                        out["doc"].append(doc)
                        out["tid"].append(tid)
                        out["pos"].append(pos)
                        out["n_lines"].append(len(lines))
            return out

        return work

    schema = "h1 bigint, h2 bigint, doc bigint, tid bigint, pos int, n_lines int"
    return in_slices(_identified(docs), make, schema)


def _hot_facts(lines: Staged, hot_rows: int) -> Staged:
    """Documents and holder of every key with many rows."""
    per_doc = lines.df.groupBy("h1", "h2", "doc").agg(F.count(F.lit(1)).alias("n"))
    facts = per_doc.groupBy("h1", "h2").agg(
        F.sum("n").alias("n"), F.count(F.lit(1)).alias("n_docs"), F.max("doc").alias("holder")
    )
    deals = F.ceil(F.col("n") / hot_rows).cast("int").alias("deals")
    return stage(facts.filter(F.col("n") > hot_rows).select("h1", "h2", "n_docs", "holder", deals), "hot-lines")


def _dropped(batches: Iterator[pa.RecordBatch], min_docs: int) -> Iterator[pa.RecordBatch]:
    """Rows to drop from rows sorted by key, documents descending, position."""
    key, first, last, seen, held = None, 0, 0, 0, []
    for batch in batches:
        out = []
        columns = [batch.column(i).to_pylist() for i in range(batch.num_columns)]
        for h1, h2, doc, tid, pos, n_lines, n_docs, holder in zip(*columns, strict=True):
            if n_docs is not None:
                if n_docs >= min_docs and doc != holder:
                    out.append((doc, tid, pos, n_lines))
                continue
            if key != (h1, h2):
                key, first, last, seen, held = (h1, h2), doc, doc, 1, []
            elif doc != last:
                last, seen = doc, seen + 1
            if doc == first:
                continue
            if seen < min_docs:
                held.append((doc, tid, pos, n_lines))
            else:
                out += held
                held = []
                out.append((doc, tid, pos, n_lines))
        a = np.array(out, np.int64).reshape(-1, 4)
        yield pa.RecordBatch.from_arrays(
            [pa.array(a[:, 0]), pa.array(a[:, 1]), pa.array(a[:, 2], pa.int32()), pa.array(a[:, 3], pa.int32())],
            names=["doc", "tid", "pos", "n_lines"],
        )


def drop_rows(lines: Staged, min_docs: int = MIN_DOCS, hot_rows: int = HOT_ROWS) -> DataFrame:
    """doc, tid, pos, n_lines of every line to drop."""
    facts = _hot_facts(lines, hot_rows)
    marked = join_measured(lines.df, facts, ["h1", "h2"], "left")
    deal = F.when(F.col("deals").isNotNull(), F.pmod(F.xxhash64("doc"), F.col("deals"))).otherwise(0)
    dealt = marked.withColumn("deal", deal).repartitionByRange("h1", "h2", "deal")
    ordered = dealt.sortWithinPartitions("h1", "h2", "deal", F.desc("doc"), "tid", "pos")
    return ordered.select("h1", "h2", "doc", "tid", "pos", "n_lines", "n_docs", "holder").mapInArrow(
        lambda batches: _dropped(batches, min_docs), "doc bigint, tid bigint, pos int, n_lines int"
    )


def pack(dropped: list[int], n_lines: int) -> bytes:
    """Keep bitmap of a document, one bit a line, deflated."""
    keep = np.ones(n_lines, bool)
    keep[dropped] = False
    return zlib.compress(np.packbits(keep).tobytes())


def unpack(bitmap: bytes, n_lines: int) -> np.ndarray:
    return np.unpackbits(np.frombuffer(zlib.decompress(bitmap), np.uint8), count=n_lines).view(bool)


def keep_bitmaps(
    docs: DataFrame, min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS, hot_rows: int = HOT_ROWS
) -> DataFrame:
    """doc, tid, keep (compressed bitmap) of every text that loses lines."""
    lines = stage(line_keys(docs, min_chars), "line-keys")
    drops = drop_rows(lines, min_docs, hot_rows).groupBy("doc", "tid").agg(
        F.collect_set("pos").alias("dropped"), F.max("n_lines").alias("n_lines")
    )

    def make():
        def work(rows):
            packed = [pack(d, n) for d, n in zip(rows.pop("dropped"), rows["n_lines"], strict=True)]
            return {"doc": rows["doc"], "tid": rows["tid"], "keep": packed}

        return work

    return in_slices(drops, make, "doc bigint, tid bigint, keep binary")


def _kept_lines(text: bytes, keep: bytes | None) -> tuple[bytes, int, int]:
    lines = text.split(b"\n")
    if keep is None:
        return text, len(lines), 0
    stays = unpack(keep, len(lines))
    return b"\n".join([x for x, k in zip(lines, stays, strict=True) if k]), len(lines), int((~stays).sum())


def with_bitmaps(docs: DataFrame, bitmaps: Staged) -> DataFrame:
    """The documents with the columns doc, tid (internal) and keep beside their own."""
    doc = F.coalesce(F.col("doc_id").cast("long"), F.lit(_NO_ID)).alias("doc")
    tid = F.xxhash64(F.coalesce("text", F.lit(""))).alias("tid")
    own = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("own")
    return join_measured(docs.select(own, doc, tid), bitmaps, ["doc", "tid"], "left")


def dedup_lines(docs: DataFrame, **limits: int) -> DataFrame:
    """The documents with their kept lines as text; all other columns unchanged.

    A text that loses nothing keeps its null; one that loses all lines becomes empty.
    """
    joined = with_bitmaps(docs, stage(keep_bitmaps(docs, **limits), "keep-bitmaps"))
    own = [F.col("own").getField(c).alias(c) for c in docs.columns]

    def make():
        def work(rows):
            pairs = zip(rows["given"], rows["keep"], strict=True)
            return {"kept": [_kept_lines(t.encode("utf-8"), k)[0].decode("utf-8") for t, k in pairs]}

        return work

    cut = joined.filter("keep is not null").select("own", F.col("own.text").alias("given"), "keep")
    cut = in_slices(cut, make, f"{ddl(cut, ['own'])}, kept string", use=["given", "keep"])
    new = [F.col("kept").alias(c) if c == "text" else x for c, x in zip(docs.columns, own, strict=True)]
    return joined.filter("keep is null").select(own).unionByName(cut.select(new))


def digest(docs: DataFrame, bitmaps: Staged, key: str = "doc_id") -> DataFrame:
    """Per document: lines, dropped lines, and the hash of what stays."""
    kind = docs.schema[key].dataType.simpleString()
    joined = with_bitmaps(docs.select(key, "text"), bitmaps)
    wanted = joined.select(
        F.col(f"own.{key}").alias(key),
        F.coalesce("own.text", F.lit("")).cast("binary").alias("text"),
        "keep",
    )

    def make():
        def work(rows):
            done = [_kept_lines(t, k) for t, k in zip(rows["text"], rows["keep"], strict=True)]
            return {
                key: rows[key],
                "n_lines": [d[1] for d in done],
                "n_dropped": [d[2] for d in done],
                "kept_sha256": [hashlib.sha256(d[0]).hexdigest() for d in done],
            }

        return work

    return in_slices(wanted, make, f"`{key}` {kind}, n_lines bigint, n_dropped bigint, kept_sha256 string")


def op6_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    return digest(docs, stage(keep_bitmaps(docs), "keep-bitmaps"))


OP6_SQL = """
WITH lines AS (
  SELECT doc_id, line, pos FROM (
    SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS parts FROM documents
  ), unnest(parts) WITH ORDINALITY AS t(line, pos)
), keyed AS (
  SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS k FROM lines
), common AS (
  SELECT k, max(doc_id) AS holder FROM keyed WHERE length(k) >= 40 GROUP BY k HAVING count(DISTINCT doc_id) >= 5
), judged AS (
  SELECT doc_id, line, pos, holder IS NOT NULL AND holder <> doc_id AS dropped FROM keyed LEFT JOIN common USING (k)
)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE dropped) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT dropped), '')) AS kept_sha256
FROM judged GROUP BY doc_id
"""
