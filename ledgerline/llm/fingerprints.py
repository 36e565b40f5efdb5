"""Document fingerprints by one-permutation MinHash, and their likeness.

Every distinct five-word shingle is hashed once; the top bits of the hash choose one of ``BINS`` bins,
and a bin keeps its smallest hash. An empty bin borrows from a bin that is not empty: it probes the
bins in a pseudo-random order of its own, the same for all documents, so two documents borrow alike
with the probability of their similarity (optimal densification). Of each bin's minimum the lowest
``BITS`` bits are stored, two bins a byte, as hex.

Two unrelated bins still agree with probability 2^-BITS, so the share m of equal bins estimates the
Jaccard similarity as (m - 2^-BITS) / (1 - 2^-BITS), held within 0 and 1.

The edited text of a document needs its successor in descending order of ids. Texts move once, to ranges
of (id descending, hash of the text, number of the row), so rows of one id, or many equal rows, spread over
ranges. A task streams the neighbours inside its range and hands its first and its last row on; what it
makes is staged, and the last row of every range meets the first of the next one in a second, small pass
over two rows per range. There are at most ``MOST_RANGES`` ranges, as long as they need to be.

Defined cases: a null text is empty; a text without words has an empty set and the empty string as
fingerprint, like another of them by 1 and like any other by 0; fewer than five words are one shingle.
A null id comes last in descending order. Rows that share an id follow each other by hash of text; repeated
rows have equal fingerprints. A single document is its own successor. An empty table gives an empty
result. Other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from ledgerline.llm.common import (
    Shingles,
    ddl,
    documents,
    in_slices,
    mixed,
    stage,
)

BINS = 512
BITS = 4
SEED = 1
BUCKET_ROWS = 8192
MOST_RANGES = 50_000


def probe_order(bins: int = BINS, seed: int = SEED) -> np.ndarray:
    """rank[i, j]: when empty bin i probes bin j."""
    cell = np.arange(bins * bins, dtype=np.uint64).reshape(bins, bins) + np.uint64(seed << 40)
    return np.argsort(np.argsort(mixed(mixed(cell)), axis=1), axis=1).astype(np.uint16)


class MinHash:
    """Fingerprints of texts; remembers the hashes of words."""

    def __init__(self, bins: int = BINS, bits: int = BITS, seed: int = SEED):
        if bits not in (1, 2, 4, 8) or bins & (bins - 1) or bins * bits % 8:
            raise ValueError("bins must be a power of two, bits 1, 2, 4 or 8")
        self.bins, self.bits = bins, bits
        self._shift = np.uint64(64 - (bins.bit_length() - 1))
        self._rank = probe_order(bins, seed)
        # A value that several bins hold gets other bits in each, else few shingles agree by chance in all.
        self._salts = mixed(np.arange(1, bins + 1, dtype=np.uint64))
        self._shingles = Shingles()

    def all_values(self, texts: list[bytes | None]) -> list[np.ndarray | None]:
        """Per text the low-order bits of the minimum of every bin; None for an empty set."""
        return [self._values(h) if len(h) else None for h in self._shingles.of(texts)]

    def _values(self, hashes: np.ndarray) -> np.ndarray:
        where = hashes >> self._shift  # sorted hashes: the first of each bin is its minimum
        first = np.flatnonzero(np.r_[True, where[1:] != where[:-1]])
        full = where[first].astype(np.int64)
        least = np.zeros(self.bins, np.uint64)
        least[full] = hashes[first]
        if len(full) < self.bins:
            empty = np.ones(self.bins, bool)
            empty[full] = False
            probes = self._rank[np.flatnonzero(empty)[:, None], full]
            least[empty] = least[full[np.argmin(probes, axis=1)]]
        return (mixed(least + self._salts) & np.uint64((1 << self.bits) - 1)).astype(np.uint8)

    def packed(self, values: np.ndarray | None) -> bytes:
        if values is None:
            return b""
        per = 8 // self.bits
        shifts = np.arange(0, 8, self.bits, dtype=np.uint8)
        return np.bitwise_or.reduce(values.reshape(-1, per) << shifts, axis=1).astype(np.uint8).tobytes()

    def pack(self, values: np.ndarray | None) -> str:
        return self.packed(values).hex()

    def unpack(self, fingerprint: str) -> np.ndarray | None:
        if not fingerprint:
            return None
        data = np.frombuffer(bytes.fromhex(fingerprint), np.uint8)
        shifts = np.arange(0, 8, self.bits, dtype=np.uint8)
        return ((data[:, None] >> shifts) & np.uint8((1 << self.bits) - 1)).reshape(-1)

    def likeness(self, a: np.ndarray | None, b: np.ndarray | None) -> float:
        if a is None or b is None:
            return float(a is None and b is None)
        chance = 2.0**-self.bits
        share = float(np.count_nonzero(a == b)) / self.bins
        return min(1.0, max(0.0, (share - chance) / (1 - chance)))


def fingerprints(docs: DataFrame, text: str = "text", bins: int = BINS, bits: int = BITS) -> DataFrame:
    """Adds ``fingerprint`` to the documents."""
    kept = [c for c in docs.columns if c != "fingerprint"]

    def make():
        hasher = MinHash(bins, bits)

        def work(rows):
            data = [None if t is None else t.encode("utf-8") for t in rows[text]]
            return {"fingerprint": [hasher.pack(v) for v in hasher.all_values(data)]}

        return work

    return in_slices(docs.select(*kept), make, ddl(docs, kept) + ", fingerprint string", use=[text])


def edited(text: str, following: str) -> str:
    """The text with its last half replaced by the first as many characters of the next one."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


def in_ranges(docs: DataFrame, bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """doc_id and text in sorted ranges of about ``bucket_rows`` rows."""
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    parts = min(MOST_RANGES, max(1, -(-texts.count() // bucket_rows)))
    # Equal rows are told apart by a number, whatever it is: their results are the same in any order.
    numbered = texts.withColumn("__hash", F.xxhash64("text")).withColumn("__row", F.monotonically_increasing_id())
    order = [F.desc_nulls_last("doc_id"), F.asc("__hash"), F.asc("__row")]
    ranges = numbered.repartitionByRange(parts, *order).sortWithinPartitions(*order)
    return ranges.select("doc_id", "text", F.spark_partition_id().alias("range"))


_FOUND = (
    "doc_id bigint, n_chars bigint, edited_sha256 binary, fingerprint binary, edited_fingerprint binary, "
    "near_edited double, near_next double"
)


def _compared(hasher: MinHash, pairs: list[tuple]) -> list[tuple]:
    """A row of _FOUND for every (id, text, values, next text, values of the next text)."""
    changed = [edited(text, after).encode("utf-8") for _, text, _, after, _ in pairs]
    return [
        (
            doc, len(text), hashlib.sha256(new).digest(), hasher.packed(values), hasher.packed(new_values),
            hasher.likeness(values, new_values), hasher.likeness(values, next_values),
        )
        for (doc, text, values, _, next_values), new, new_values
        in zip(pairs, changed, hasher.all_values(changed), strict=True)
    ]


def _batch(rows: list[tuple], target: pa.Schema) -> pa.RecordBatch:
    columns = zip(*rows, strict=True) if rows else [()] * len(target)
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, target, strict=True)], schema=target)


def _inside_ranges(ranges: DataFrame, bins: int, bits: int) -> DataFrame:
    """_FOUND for every row but the last of each range; with ``edge`` 1 and 2 the first and the last row
    of the range as they are."""
    schema = T.StructType.fromDDL(_FOUND + ", range int, edge int, text string")
    blank = (None,) * 6

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher, arrow = MinHash(bins, bits), to_arrow_schema(schema)
        held = None  # id, text and values of the row that waits for its successor
        at_range = None
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                ids, texts, numbers = (c.to_pylist() for c in batch.slice(at, 256).columns)
                own = hasher.all_values([t.encode("utf-8") for t in texts])
                pairs, edges = [], []
                for doc, text, number, values in zip(ids, texts, numbers, own, strict=True):
                    if held is None:
                        at_range = number
                        edges.append((doc, *blank, number, 1, text))
                    else:
                        pairs.append((*held, text, values))
                    held = doc, text, values
                yield _batch([(*r, at_range, 0, None) for r in _compared(hasher, pairs)] + edges, arrow)
        if held is not None:
            yield _batch([(held[0], *blank, at_range, 2, held[1])], arrow)

    return ranges.mapInArrow(run, schema)


def _across_ranges(edges: DataFrame, bins: int, bits: int) -> DataFrame:
    """_FOUND for the last row of every range; the last of all is followed by the first of all."""
    names = T.StructType.fromDDL(_FOUND).names
    firsts, lasts = edges.filter("edge = 1"), edges.filter("edge = 2")
    whole = Window.orderBy("range")  # a row per range
    following = F.coalesce(F.lead("range").over(whole), F.first("range").over(whole))
    turns = firsts.select("range", following.alias("following"))
    after = firsts.select(F.col("range").alias("following"), F.col("text").alias("after"))
    pairs = lasts.select("range", "doc_id", "text").join(turns, "range").join(after, "following")

    def make():
        hasher = MinHash(bins, bits)

        def work(rows):
            own, others = (hasher.all_values([t.encode("utf-8") for t in rows[c]]) for c in ("text", "after"))
            found = _compared(hasher, list(zip(rows["doc_id"], rows["text"], own, rows["after"], others, strict=True)))
            return dict(zip(names, zip(*found, strict=True), strict=True))

        return work

    return in_slices(pairs.select("doc_id", "text", "after"), make, _FOUND, rows=64)


def compare_neighbours(docs: DataFrame, bins: int = BINS, bits: int = BITS, bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """Per document: its fingerprint, that of its edited text, and their likeness, and that to the
    next document's fingerprint."""
    found = stage(_inside_ranges(in_ranges(docs, bucket_rows), bins, bits), "fingerprints").df
    names = T.StructType.fromDDL(_FOUND).names
    rows = found.filter("edge = 0").select(*names).unionByName(_across_ranges(found, bins, bits))
    as_hex = {"edited_sha256", "fingerprint", "edited_fingerprint"}
    return rows.select(*[F.lower(F.hex(n)).alias(n) if n in as_hex else F.col(n) for n in names])


def op1_fingerprint_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return compare_neighbours(documents(spark, sf_dir))
