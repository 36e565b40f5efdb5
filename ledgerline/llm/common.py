"""Helpers the operators share: words, shingles, folders, checked joins, Arrow passes."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterable, Iterator
from typing import Any

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from ledgerline.scale import Staged, new_shared_path, stage

#: Words are runs of anything but these; the same set that bytes.split() and bytes.strip() use.
WORD = r"[^\x20\x09-\x0D]+"

#: A staged table is broadcast up to this measured size; beyond it a shuffle join takes over.
BROADCAST_BYTES = 32 * 1024 * 1024

#: Rows a task turns into one Arrow batch of results, and the distinct words it remembers.
SLICE_ROWS = 512
CACHE_WORDS = 250_000

SHINGLE_WORDS = 5
#: Texts are hashed together up to so many bytes; a longer text is hashed alone.
SHINGLE_BYTES = 256 * 1024

__all__ = [
    "BROADCAST_BYTES", "Remember", "Shingles", "Staged", "Substrings", "WORD", "ddl", "documents",
    "give_memory_back", "in_slices", "join_measured", "new_shared_path", "placed", "row_hash", "stage", "table",
]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents")


def join_measured(
    left: DataFrame, right: Staged, keys: list[str], how: str = "inner", limit: int = BROADCAST_BYTES
) -> DataFrame:
    """Join to a staged table: broadcast if its measured size allows it, else sort-merge.

    Right keys are unique in all uses here, so a hot left key only makes a long partition, which
    the skew rule of adaptive execution splits.
    """
    if right.bytes <= limit:
        return left.join(F.broadcast(right.df), keys, how)
    return left.join(right.df.hint("merge"), keys, how)


def placed(df: DataFrame, order: list[Column], name: str, place: str = "place") -> tuple[DataFrame, Staged]:
    """The rows of a table of plain columns with their place (from 0, gapless) in a total order.

    One range shuffle: every partition is sorted and staged with the place inside it, and a running sum
    over partitions (one row each) adds what lies before. A range can be cut anywhere between unequal
    rows, so ``order`` should tell all rows apart. The second result is the staged table behind it.
    """
    inside = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    rows = df.repartitionByRange(*order).sortWithinPartitions(*order)
    rows = stage(rows.withColumn("__part", F.spark_partition_id()).withColumn("__inside", inside), name)
    parts = rows.df.groupBy("__part").agg(F.count(F.lit(1)).alias("__n"))
    before = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)  # a row per partition
    offsets = parts.select("__part", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__before"))
    numbered = rows.df.join(F.broadcast(offsets), "__part")
    return numbered.withColumn(place, F.col("__before") + F.col("__inside")).select(*df.columns, place), rows


class Remember(dict):
    """A dict that computes what it lacks. It keeps two generations of at most ``limit`` entries each,
    so words in use survive when those seen once are let go."""

    def __init__(self, compute: Callable[[Any], Any], limit: int = CACHE_WORDS):
        super().__init__()
        self._compute, self._limit, self._old = compute, limit, {}

    def __missing__(self, key: Any) -> Any:
        value = self._old.get(key)
        if value is None:
            value = self._compute(key)
        if len(self) >= self._limit:
            self._old = dict(self)
            self.clear()
        self[key] = value
        return value


_STEP = np.uint64(0x9E3779B97F4A7C15)
_MIX_1 = np.uint64(0xBF58476D1CE4E5B9)
_MIX_2 = np.uint64(0x94D049BB133111EB)


def mixed(h: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit over all others."""
    h = (h ^ (h >> np.uint64(30))) * _MIX_1
    h = (h ^ (h >> np.uint64(27))) * _MIX_2
    return h ^ (h >> np.uint64(31))


def _letter_values() -> np.ndarray:
    return mixed(np.arange(1, 257, dtype=np.uint64) * _STEP)


class Substrings:
    """64-bit hash of any run of bytes of a text, from two running sums over the text."""

    _FACTOR = 0xA0761D6478BD642F

    def __init__(self) -> None:
        self._values = _letter_values()
        self._powers = self._inverses = np.ones(1, np.uint64)

    def load(self, codes: np.ndarray) -> None:
        n = len(codes)
        if len(self._powers) < n + 1:
            self._powers = np.r_[np.uint64(1), np.cumprod(np.full(n, self._FACTOR, np.uint64))]
            inverse = pow(self._FACTOR, -1, 1 << 64)
            self._inverses = np.r_[np.uint64(1), np.cumprod(np.full(n, inverse, np.uint64))]
        self._sums = np.zeros(n + 1, np.uint64)
        np.cumsum(self._values[codes] * self._powers[:n], out=self._sums[1:])

    def every(self, length: int) -> np.ndarray:
        """Hash of the run of ``length`` bytes at every place that has one."""
        n = len(self._sums) - length
        return mixed((self._sums[length:] - self._sums[:n]) * self._inverses[:n])

    def of(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        return mixed((self._sums[ends] - self._sums[starts]) * self._inverses[starts])


class Shingles:
    """Sets of shingle hashes of many texts at a time.

    A word's hash is the sum of a fixed random number per byte, weighted by powers of an odd number
    and so by place, modulo 2^64. Running sums over all bytes give it for every word at once: the
    difference at the word's ends, moved to place 0 by the inverse power.
    """

    _FACTOR = 0xD6E8FEB86659FD93
    _SPACE = np.zeros(256, bool)
    _SPACE[[0x20, *range(0x09, 0x0E)]] = True

    def __init__(self) -> None:
        self._values = _letter_values()
        self._powers = self._inverses = np.ones(1, np.uint64)

    def _places(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self._powers) < n:
            def powers(x):
                return np.r_[np.uint64(1), np.cumprod(np.full(n - 1, x, np.uint64))]

            self._powers = powers(self._FACTOR)
            self._inverses = powers(pow(self._FACTOR, -1, 1 << 64))
        return self._powers[:n], self._inverses[:n]

    def _words(self, data: bytes) -> tuple[np.ndarray, np.ndarray]:
        """Start and hash of every word of lower-case data that ends in a space."""
        codes = np.frombuffer(data, np.uint8)
        space = self._SPACE[codes]
        edges = np.flatnonzero(space[1:] != space[:-1]) + 1
        if not space[0]:
            edges = np.r_[0, edges]
        starts, ends = edges[0::2], edges[1::2]
        powers, inverses = self._places(len(codes))
        sums = np.zeros(len(codes) + 1, np.uint64)
        np.cumsum(self._values[codes] * powers, out=sums[1:])
        return starts, mixed((sums[ends] - sums[starts]) * inverses[starts])

    def of(self, texts: Iterable[bytes | None]) -> list[np.ndarray]:
        """Sorted distinct 64-bit hashes of the five-word shingles of each text.

        A-Z are lower-cased. Fewer than five words form one shingle; no words give an empty array.
        """
        out, held, size = [], [], 0
        for text in texts:
            held.append(text or b"")
            size += len(held[-1])
            if size >= SHINGLE_BYTES:
                out += self._sets(held)
                held, size = [], 0
        return out + self._sets(held) if held else out

    def _sets(self, texts: list[bytes]) -> list[np.ndarray]:
        data = (b"\n".join(texts) + b"\n").lower()
        starts, hashes = self._words(data)
        lengths = np.fromiter((len(t) + 1 for t in texts), np.int64, len(texts))
        edges = np.searchsorted(starts, np.r_[0, np.cumsum(lengths)])
        totals = self._joined(hashes, SHINGLE_WORDS)
        out = []
        for at, end in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True):
            n = end - at
            if n >= SHINGLE_WORDS:
                h = np.sort(totals[at : end - SHINGLE_WORDS + 1])
                out.append(h[np.r_[True, h[1:] != h[:-1]]])
            else:
                out.append(self._joined(hashes[at:end], n) if n else np.empty(0, np.uint64))
        return out

    @staticmethod
    def _joined(hashes: np.ndarray, k: int) -> np.ndarray:
        m = max(0, len(hashes) - k + 1)
        total = hashes[:m] + np.uint64(k)
        for i in range(1, k):
            total = total * _STEP + hashes[i : m + i]
        return mixed(total)


def in_slices(
    df: DataFrame,
    make: Callable[[], Callable[[dict[str, list]], dict[str, Iterable]]],
    schema: str,
    rows: int = SLICE_ROWS,
    use: list[str] | None = None,
) -> DataFrame:
    """One Arrow pass: ``make()`` runs once per task and gives a function from columns to columns.

    The function sees at most ``rows`` rows at a time as Python lists (the columns ``use``, or all),
    so what a task holds is bounded by a few rows and not by a partition. Columns of ``schema`` that
    it does not return are passed on as they are.
    """
    target = T.StructType.fromDDL(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        arrow = to_arrow_schema(target)
        give_memory_back()  # of the task that this worker did before
        work = make()
        give_memory_back()
        try:
            for batch in batches:
                for at in range(0, batch.num_rows, rows):
                    part = batch.slice(at, rows)
                    out = work({n: part.column(n).to_pylist() for n in use or part.schema.names})
                    arrays = [
                        pa.array(out[f.name], f.type) if f.name in out else part.column(f.name).cast(f.type)
                        for f in arrow
                    ]
                    yield pa.RecordBatch.from_arrays(arrays, schema=arrow)
        finally:
            del work
            give_memory_back()

    return df.mapInArrow(run, schema)


def give_memory_back() -> None:
    """Hand memory that a task has freed back to the system: workers live on and wait beside others."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (OSError, AttributeError):  # another C library
        pass


def row_hash(df: DataFrame) -> Column:
    """A hash of the whole row; maps, which have no hash, go in as text."""
    plain = [F.col(f"`{f.name}`") for f in df.schema.fields if "map<" not in f.dataType.simpleString()]
    maps = [F.to_json(F.struct(F.col(f"`{f.name}`"))) for f in df.schema.fields if "map<" in f.dataType.simpleString()]
    return F.xxhash64(*plain, *maps)


def ddl(df: DataFrame, columns: list[str]) -> str:
    """The columns with their types, as the start of a schema."""
    types = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    return ", ".join(f"`{c}` {types[c]}" for c in columns)
