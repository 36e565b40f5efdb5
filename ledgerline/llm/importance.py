"""Importance resampling of a corpus towards a target distribution over hashed n-grams.

Features are all runs of one to ``max_words`` words, repeats counted; a feature's bucket is the CRC-32
of its bytes modulo ``buckets``. A document is normalised (A-Z lower-cased, everything between words
one space) and scanned once: the running CRC after every word is kept, and as

    crc(prefix to b) = shift(crc(prefix to a), b - a) XOR crc(bytes a to b),

where ``shift`` advances a CRC over b - a zero bytes and is linear over GF(2), the CRC of any n-gram is
the later prefix XOR the shifted earlier one. Shifts by any length come from tables of one byte digit
of the length each, so no n-gram is ever cut out of the text or hashed again.

Two passes over the texts: bucket counts (added up per task, so a task sends at most ``buckets`` rows),
then scores with the log-ratio of target to corpus per bucket, a table of ``buckets`` numbers. Gumbel
noise from the document's id makes the best scores a draw without replacement. Places come from one
range sort of narrow rows.

Defined cases: a null or empty text has no words, no features and weight 0. A null id takes the noise of
an empty id and comes before all others in ties. Rows that share an id share their noise, and in ties
keep any order among themselves; repeated rows are rows of their own. Empty tables give empty results; an
empty target counts 0 everywhere. Other columns are ignored, or passed on by ``draw``.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from itertools import accumulate
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.llm.common import SLICE_ROWS, ddl, documents, in_slices, placed, stage, table

MAX_WORDS = 2
BUCKETS = 10_000
MIN_WORDS = 20
SHARE = 25
SEED = 7

_WORD_BYTES = {*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)}
_NORMAL = bytes(c if c in _WORD_BYTES else 0x20 for c in bytes(range(256)).lower())


def _over_zero(crc: np.ndarray) -> np.ndarray:
    """The CRC register after one more zero byte."""
    low = crc & np.uint32(0xFF)
    for _ in range(8):
        low = np.where(low & 1, (low >> 1) ^ np.uint32(0xEDB88320), low >> 1)
    return (crc >> np.uint32(8)) ^ low


class Shifts:
    """CRC registers moved over any number of zero bytes.

    ``_digits[d][v, i, b]`` is the image of byte ``b`` at place ``i`` of the register under a shift of
    ``v * 256**d`` bytes; an image of the whole register is the XOR of four of them.
    """

    def __init__(self) -> None:
        byte = np.arange(256, dtype=np.uint32)
        self._identity = np.stack([byte << np.uint32(8 * i) for i in range(4)])
        self._digits = [self._table(_over_zero)]

    def _table(self, step) -> np.ndarray:
        images = [self._identity]
        for _ in range(255):
            images.append(step(images[-1]))
        return np.stack(images)

    @staticmethod
    def _moved(images: np.ndarray, digit: np.ndarray, crc: np.ndarray) -> np.ndarray:
        out = images[digit, 0, crc & np.uint32(0xFF)]
        for i in range(1, 4):
            out = out ^ images[digit, i, (crc >> np.uint32(8 * i)) & np.uint32(0xFF)]
        return out

    def _digit(self, d: int) -> np.ndarray:
        while len(self._digits) <= d:
            last = self._digits[-1]

            def step(crc, last=last):  # 255 and one more steps of the digit below
                once = self._moved(last, np.full(crc.shape, 255), crc)
                return self._moved(last, np.full(crc.shape, 1), once)

            self._digits.append(self._table(step))
        return self._digits[d]

    def __call__(self, crc: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        out, d = self._moved(self._digits[0], lengths & 255, crc), 1
        rest = lengths >> 8
        while len(at := np.flatnonzero(rest)):
            out[at] = self._moved(self._digit(d), rest[at] & 255, out[at])
            rest, d = rest >> 8, d + 1
        return out


class NGrams:
    """CRC-32 of every run of one to ``max_words`` words of many texts, from prefix CRCs alone."""

    def __init__(self, max_words: int) -> None:
        self._max, self._shift = max_words, Shifts()

    def of(self, texts: list[bytes | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Words per text, and the CRC and the text number of every n-gram."""
        normal = [b" ".join((t or b"").translate(_NORMAL).split()) for t in texts]
        counts = np.array([t.count(b" ") + 1 if t else 0 for t in normal], np.int64)
        whole = b" ".join(filter(None, normal))
        if not whole:
            return counts, np.empty(0, np.uint32), np.empty(0, np.int64)
        parts = whole.replace(b" ", b"\n ").split(b"\n")  # every word but the first with the space before it
        n = len(parts)
        ends = np.fromiter(accumulate(parts, lambda crc, part: crc32(part, crc), initial=0), np.uint32, n + 1)
        to = np.cumsum(np.fromiter(map(len, parts), np.int64, n))  # places where words end
        space = _over_zero(ends[1:-1] ^ np.uint32(0xFFFFFFFF) ^ np.uint32(0x20)) ^ np.uint32(0xFFFFFFFF)
        starts = np.r_[np.uint32(0), space]  # prefix CRCs where words start
        at = np.r_[0, to[:-1] + 1]
        ends, owner = ends[1:], np.repeat(np.arange(len(texts)), counts)
        crcs, owners = [], []
        for k in range(min(self._max, n)):
            first = np.flatnonzero(owner[: n - k] == owner[k:])
            last = first + k
            crcs.append(ends[last] ^ self._shift(starts[first], to[last] - at[first]))
            owners.append(owner[first])
        return counts, np.concatenate(crcs), np.concatenate(owners)


def bucket_counts(
    docs: DataFrame, max_words: int = MAX_WORDS, buckets: int = BUCKETS, text: str = "text"
) -> DataFrame:
    """bucket, n: features of all texts per bucket that has any."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grams, total = NGrams(max_words), np.zeros(buckets, np.int64)
        for batch in batches:
            for at in range(0, batch.num_rows, SLICE_ROWS):
                crcs = grams.of(batch.slice(at, SLICE_ROWS).column(0).to_pylist())[1]
                total += np.bincount(crcs % np.uint32(buckets), minlength=buckets)
        found = np.flatnonzero(total)
        yield pa.RecordBatch.from_pydict({"bucket": pa.array(found, pa.int32()), "n": pa.array(total[found])})

    counted = docs.select(F.col(text).cast("binary").alias("text")).mapInArrow(run, "bucket int, n bigint")
    return counted.groupBy("bucket").agg(F.sum("n").alias("n"))


def gains(corpus: DataFrame, target: DataFrame, buckets: int = BUCKETS) -> np.ndarray:
    """Gain of every bucket in thousandths; the two counts are tables of at most ``buckets`` rows."""
    counts = []
    for side in (corpus, target):
        total = np.zeros(buckets)
        for row in side.collect():
            total[row["bucket"]] = row["n"]
        counts.append(total.tolist())
    s_all, t_all = sum(counts[0]), sum(counts[1])
    return np.array(
        [
            math.floor(1000 * math.log(((t + 1) * (s_all + buckets)) / ((s + 1) * (t_all + buckets))))
            for s, t in zip(*counts, strict=True)
        ],
        np.int64,
    )


def weights(docs: DataFrame, gain: np.ndarray, max_words: int, key: str = "doc_id") -> DataFrame:
    """own (all columns of the document), id, n_words, n_features, weight."""

    def make():
        grams = NGrams(max_words)

        def work(rows):
            words, crcs, owner = grams.of(rows["text"])
            n = np.bincount(owner, minlength=len(words))
            total = np.zeros(len(words), np.int64)
            np.add.at(total, owner, gain[crcs % np.uint32(len(gain))])
            return {"n_words": words, "n_features": n, "weight": np.where(n > 0, total // np.maximum(n, 1), 0)}

        return work

    own = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("own")
    rows = docs.select(own, F.col(f"`{key}`").cast("long").alias("id"), F.col("text").cast("binary").alias("text"))
    schema = f"{ddl(rows, ['own', 'id'])}, n_words bigint, n_features bigint, weight bigint"
    return in_slices(rows, make, schema, use=["text"])


def noise(key: Column, seed: int) -> Column:
    """Gumbel noise in thousandths from the id alone."""
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(key.cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(text, 256), 1, 8), 16, 10).cast("long")
    uniform = (h.cast("double") + F.lit(0.5)) / F.lit(4294967296.0)
    return F.floor(F.lit(-1000.0) * F.log(-F.log(uniform)))


def scored(
    docs: DataFrame,
    target: DataFrame,
    max_words: int = MAX_WORDS,
    buckets: int = BUCKETS,
    seed: int = SEED,
    key: str = "doc_id",
) -> DataFrame:
    """own, id, n_words, n_features, weight, score of every row."""
    gain = gains(bucket_counts(docs, max_words, buckets), bucket_counts(target, max_words, buckets), buckets)
    return weights(docs, gain, max_words, key).withColumn("score", F.col("weight") + noise(F.col("id"), seed))


_ORDER = ["score", "id", "row"]


def ranked(rows: DataFrame, share: int = SHARE, min_words: int = MIN_WORDS) -> DataFrame:
    """The narrow rows (id, n_words, score and more plain columns) with rank; null where not drawn."""
    columns = rows.columns
    numbered = rows.withColumn("row", F.monotonically_increasing_id())
    enough = F.col("n_words") >= min_words
    kept = stage(numbered, "scores", n=F.count_if(enough))
    taken = share * int(kept.metrics["n"] or 0) // 100
    order = [F.desc("score"), F.asc_nulls_first("id"), F.asc("row")]
    placed_rows, _ = placed(kept.df.filter(enough), order, "ranked")
    rank = F.when(F.col("place") < taken, F.col("place") + 1).alias("rank")
    short = kept.df.filter(~enough).select(*columns, F.lit(None).cast("long").alias("rank"))
    return placed_rows.select(*columns, rank).unionByName(short)


def draw(docs: DataFrame, target: DataFrame, share: int = SHARE, min_words: int = MIN_WORDS, **how) -> DataFrame:
    """The drawn documents themselves, with all their columns.

    The last score and id of the draw are the cut; rows that are equal in both to the last drawn one
    come along.
    """
    rows = scored(docs, target, **how)
    drawn = ranked(rows.select("id", "n_words", "score"), share, min_words).filter("rank is not null")
    last = drawn.agg(F.max_by(F.struct("score", "id"), "rank").alias("last")).collect()[0]["last"]
    if last is None:
        return docs.limit(0)
    tie = F.col("id").isNull() if last["id"] is None else F.col("id").isNull() | (F.col("id") <= last["id"])
    inside = (F.col("score") > last["score"]) | ((F.col("score") == last["score"]) & tie)
    return rows.filter((F.col("n_words") >= min_words) & inside).select("own.*")


def op11_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = scored(documents(spark, sf_dir).select("doc_id", "text"), table(spark, sf_dir, "benchmark"))
    narrow = rows.select("id", "n_words", "n_features", "weight", "score")
    return ranked(narrow).select(F.col("id").alias("doc_id"), "n_features", "weight", "score", "rank")


#: CRC-32 byte by byte over the distinct features, with the table of the polynomial made in SQL.
OP11_SQL = """
WITH RECURSIVE bits(b, step, v) AS (
  SELECT b, 0, CAST(b AS BIGINT) FROM unnest(range(256)) AS u(b)
  UNION ALL
  SELECT b, step + 1, CASE WHEN v % 2 = 1 THEN xor(v // 2, 3988292384) ELSE v // 2 END FROM bits WHERE step < 8
), crc_table AS (
  SELECT list(v ORDER BY b) AS t FROM bits WHERE step = 8
), texts AS (
  SELECT 0 AS side, doc_id AS id, text FROM documents UNION ALL SELECT 1, item_id, text FROM benchmark
), words AS (
  SELECT side, id, list_filter(regexp_split_to_array(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+'), lambda w: w <> '') AS ws FROM texts
), grams AS (
  SELECT side, id, unnest(ws) AS g FROM words
  UNION ALL
  SELECT side, id, ws[i] || ' ' || ws[i + 1] FROM words, unnest(range(1, len(ws))) AS u(i)
), counted AS (
  SELECT side, id, g, count(*) AS c FROM grams GROUP BY ALL
), bytes AS (
  SELECT g, list_transform(range(octet_length(encode(g))),
    lambda i: CAST('0x' || substr(hex(encode(g)), 2 * i + 1, 2) AS BIGINT)) AS bs
  FROM (SELECT DISTINCT g FROM counted)
), hashed AS (
  SELECT g, CAST(xor(list_reduce(list_concat([CAST(4294967295 AS BIGINT)], bs),
    lambda c, b: xor(c // 256, t[xor(c, b) % 256 + 1])), 4294967295) % 10000 AS INTEGER) AS bucket
  FROM bytes, crc_table
), buckets AS (
  SELECT bucket, sum(c) FILTER (WHERE side = 0) AS s, sum(c) FILTER (WHERE side = 1) AS t
  FROM counted JOIN hashed USING (g) GROUP BY bucket
), totals AS (
  SELECT coalesce(sum(s), 0) AS s_all, coalesce(sum(t), 0) AS t_all FROM buckets
), gain AS (
  SELECT bucket, CAST(floor(1000 * ln(CAST((coalesce(t, 0) + 1) * (s_all + 10000) AS DOUBLE)
    / CAST((coalesce(s, 0) + 1) * (t_all + 10000) AS DOUBLE))) AS BIGINT) AS gain FROM buckets, totals
), weighed AS (
  SELECT id, CAST(sum(c) AS BIGINT) AS n_features, CAST(floor(CAST(sum(c * gain) AS DOUBLE) / sum(c)) AS BIGINT) AS weight
  FROM counted JOIN hashed USING (g) JOIN gain USING (bucket) WHERE side = 0 GROUP BY id
), scored AS (
  SELECT id AS doc_id, coalesce(n_features, 0) AS n_features, coalesce(weight, 0) AS weight, len(ws) >= 20 AS enough,
    coalesce(weight, 0) + CAST(floor(-1000 * ln(-ln((CAST('0x' || substr(sha256('7:' || id), 1, 8) AS BIGINT) + 0.5::DOUBLE)
      / 4294967296.0::DOUBLE))) AS BIGINT) AS score
  FROM words LEFT JOIN weighed USING (id) WHERE side = 0
), ranked AS (
  SELECT *, CASE WHEN enough THEN row_number() OVER (PARTITION BY enough ORDER BY score DESC, doc_id) END AS rank,
    count(*) FILTER (WHERE enough) OVER () AS n FROM scored
)
SELECT doc_id, n_features, weight, score, CASE WHEN rank <= 25 * n // 100 THEN rank END AS rank FROM ranked
"""
