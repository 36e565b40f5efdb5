"""Phrase collocations from counts of the longest windows alone.

Texts are cut into pieces at punctuation and line ends, pieces into words. Every word starts one window:
itself and the words that follow it in its piece, up to ``order``, padded with nulls (lead columns w1 to
w5). Only whole windows are counted; Spark's ROLLUP over (lang, w1, ..., w5) then sums them to all
shorter prefixes, which are the counts of all shorter phrases. No n-gram order is exploded by itself.

The same is done twice. With order 2, over 64-bit names of words, it tells which word pairs are frequent;
a phrase is frequent only if all its pairs are, so the second pass ends a window where the next pair
cannot be. The frequent pairs reach the tasks as a bitmap of ``PAIR_BITS`` bits whatever their number: a
pair that shares a bit with a frequent one merely makes a longer window. So names and bits never decide a
result: the second pass counts the words themselves.

Scores are exact: products are decimals of 38 digits, and division drops the fraction.

Defined cases: a null or empty text has no words; a null language is ``und``. Repeated rows count each.
Ids play no part. Empty tables give empty results. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgerline.llm.common import Substrings, documents, join_measured, mixed, stage

ORDER = 5
MIN_COUNT = 100
SHARE = 100
TOP = 2000

#: Bits of the map of frequent pairs (8 MB), and how many of them one task packs.
PAIR_BITS = 1 << 26
_BLOCK_BITS = 1 << 19
#: Texts are cut into words together up to so many bytes; a longer text alone.
_BATCH_BYTES = 1 << 21

_STEP = np.uint64(0x9E3779B97F4A7C15)
_KIND = np.zeros(256, np.uint8)  # 0 word, 1 space, 2 end of a piece
_KIND[[0x20, 0x09]] = 1
_KIND[[*b".,;:!?", *range(0x0A, 0x0E)]] = 2


class Words:
    """All words of some texts: where they are, their names, and the piece each belongs to."""

    def __init__(self) -> None:
        self._runs = Substrings()

    def load(self, texts: list[bytes]) -> None:
        self.data = (b"\n".join(texts) + b"\n").lower()
        codes = np.frombuffer(self.data, np.uint8)
        kind = _KIND[codes]
        word = kind == 0
        edges = np.flatnonzero(word[1:] != word[:-1]) + 1
        if word[0]:
            edges = np.r_[0, edges]
        self.starts, self.ends = edges[0::2], edges[1::2]
        self.piece = np.cumsum(kind == 2)[self.starts]
        self._runs.load(codes)
        self.names = self._runs.of(self.starts, self.ends)

    def follows(self, k: int) -> np.ndarray:
        """Whether the word has a k-th next word in its piece, for words that have one in the batch."""
        return self.piece[: len(self.piece) - k] == self.piece[k:]


def _batches(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, list[bytes]]]:
    """Texts of one language at a time, of bounded size."""
    for batch in batches:
        held: dict[str, list[bytes]] = {}
        sizes: dict[str, int] = {}
        for lang, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
            data = text.as_py()
            held.setdefault(lang, []).append(data)
            sizes[lang] = sizes.get(lang, 0) + len(data)
            if sizes[lang] >= _BATCH_BYTES:
                yield lang, held.pop(lang)
                sizes.pop(lang)
        yield from held.items()


def _seed(lang: str) -> np.uint64:
    return np.uint64(int.from_bytes(lang.encode("utf-8")[:64], "little") * 0x9E3779B97F4A7C15 % (1 << 64))


def _pairs(words: Words, lang: str) -> tuple[np.ndarray, np.ndarray]:
    """The words that have a next one, and the names of the pairs."""
    first = np.flatnonzero(words.follows(1))
    a, b = words.names[first], words.names[first + 1]
    return first, mixed((a + _seed(lang)) * _STEP + b)


def _texts(docs: DataFrame) -> DataFrame:
    lang = F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang")
    text = F.col("text").cast("string").cast("binary")
    return docs.select(lang, text.alias("text")).filter("octet_length(text) > 0")


def frequent_pairs(docs: DataFrame, min_count: int = MIN_COUNT) -> DataFrame:
    """pair: 64-bit names of the pairs of neighbouring words with ``min_count`` occurrences in a language."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = Words()
        for lang, texts in _batches(batches):
            words.load(texts)
            pair, n = np.unique(_pairs(words, lang)[1], return_counts=True)
            yield pa.RecordBatch.from_pydict({"pair": pa.array(pair.view(np.int64)), "n": pa.array(n, pa.int32())})

    counted = _texts(docs).mapInArrow(run, "pair bigint, n int").groupBy("pair").agg(F.sum("n").alias("n"))
    return counted.filter(F.col("n") >= min_count).select("pair")


def pair_map(pairs: DataFrame, bits: int = PAIR_BITS) -> np.ndarray:
    """A bitmap with the bit of every pair set; its size does not depend on the number of pairs."""
    block_bits = min(bits, _BLOCK_BITS)
    bit = F.pmod(F.col("pair"), F.lit(bits))
    set_bits = pairs.select(bit.alias("bit")).distinct()
    blocks = set_bits.groupBy(F.floor(F.col("bit") / block_bits).cast("int").alias("block")).agg(
        F.collect_list(F.pmod(F.col("bit"), F.lit(block_bits)).cast("int")).alias("at")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                field = np.zeros(block_bits, np.uint8)
                field[batch.column("at")[i].values.to_numpy()] = 1
                yield pa.RecordBatch.from_pydict(
                    {"block": batch.column("block").slice(i, 1), "data": [np.packbits(field).tobytes()]}
                )

    out = np.zeros(bits // 8, np.uint8)
    for row in blocks.mapInArrow(run, "block int, data binary").toLocalIterator():
        at = row["block"] * block_bits // 8
        out[at : at + block_bits // 8] = np.frombuffer(row["data"], np.uint8)
    return out


def _has(pair_bits: np.ndarray, pair: np.ndarray) -> np.ndarray:
    bit = (pair.view(np.int64) % (len(pair_bits) * 8)).astype(np.int64)
    return (pair_bits[bit >> 3] >> (7 - (bit & 7)).astype(np.uint8)) & 1 == 1


def windows(docs: DataFrame, pair_bits: np.ndarray, order: int = ORDER) -> DataFrame:
    """lang, w1 .. w<order>, n: windows of all words, combined per batch, cut after a pair not in the map."""
    columns = [f"w{k}" for k in range(1, order + 1)]
    spread = docs.sparkSession.sparkContext.broadcast(pair_bits)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, known = Words(), spread.value
        for lang, texts in _batches(batches):
            words.load(texts)
            total = len(words.names)
            if not total:
                continue
            first, pair = _pairs(words, lang)
            good = np.zeros(total, np.int64)
            good[first[_has(known, pair)]] = 1
            length = np.ones(total, np.int64)  # words in the window
            alive = good.copy()
            for k in range(1, order):
                length += alive
                shifted = np.zeros(total, np.int64)
                shifted[: total - k] = good[k:]
                alive = alive & shifted
            # Equal windows get equal 128-bit names; sorted by one half, cut where either half changes.
            one, two = np.zeros(total, np.uint64), np.zeros(total, np.uint64)
            for k in range(order):
                name = np.zeros(total, np.uint64)
                name[: total - k] = words.names[k:]
                name[length <= k] = 0
                one, two = mixed(one * _STEP + name), (two ^ name) * _STEP + np.uint64(k)
            by = np.argsort(one, kind="stable")
            change = np.r_[True, (one[by][1:] != one[by][:-1]) | (two[by][1:] != two[by][:-1])]
            at = np.flatnonzero(change)
            n = np.diff(np.r_[at, total])
            kept = by[at]
            data, starts, ends = words.data, words.starts.tolist(), words.ends.tolist()
            out = {"lang": pa.array([lang] * len(kept), pa.string())}
            size = length[kept]
            for k, column in enumerate(columns):
                values = [
                    data[starts[i] : ends[i]] if has else None
                    for i, has in zip((kept + k).tolist(), (size > k).tolist(), strict=True)
                ]
                out[column] = pa.array(values, pa.binary()).cast(pa.string())
            out["n"] = pa.array(n, pa.int64())
            yield pa.RecordBatch.from_pydict(out)

    schema = ", ".join(["lang string", *[f"{c} string" for c in columns], "n bigint"])
    return _texts(docs).mapInArrow(run, schema)


def phrase_counts(counted: DataFrame, order: int = ORDER, min_count: int = MIN_COUNT) -> DataFrame:
    """lang, words (array; empty: the language as a whole), f: ROLLUP of windows to all their prefixes.

    Phrases below ``min_count`` are left out, and so are prefixes that end in padding.
    """
    columns = [f"w{k}" for k in range(1, order + 1)]
    once = counted.groupBy("lang", *columns).agg(F.sum("n").alias("n"))
    levels = once.rollup("lang", *columns).agg(F.sum("n").alias("f"), F.grouping_id().alias("level"))
    # A grouping id has a bit per column, set where the column is summed away: 2^j - 1 leaves all but j.
    size = F.lit(order) - F.log2(F.col("level") + 1).cast("int")
    words = F.slice(F.array(*columns), 1, size)
    whole = F.forall(words, lambda w: w.isNotNull())
    kept = levels.filter(F.col("level") < (1 << (order + 1)) - 1).select("lang", words.alias("words"), "f", whole.alias("whole"))
    return kept.filter(F.col("whole") & ((F.size("words") == 0) | (F.col("f") >= min_count))).drop("whole")


def _exact(column: str):
    return F.col(column).cast("decimal(38,0)")


def scored_phrases(docs: DataFrame, order: int = ORDER, min_count: int = MIN_COUNT, share: int = SHARE) -> DataFrame:
    """lang, phrase, a, l, r, n, score of all phrases that stay."""
    pairs = stage(frequent_pairs(docs, min_count), "frequent-pairs")
    counted = windows(docs, pair_map(pairs.df), order)
    named = phrase_counts(counted, order, min_count).select(
        "lang", F.concat_ws(" ", "words").alias("phrase"), F.size("words").cast("int").alias("size"), "f"
    )
    counts = stage(named, "phrase-counts")
    phrases = counts.df.filter("size >= 1").select("lang", "phrase", "f")
    staged = stage(phrases, "phrases")
    totals = stage(counts.df.filter("size = 0").select("lang", F.col("f").alias("n")), "totals")
    words = F.split("phrase", " ", -1)

    def part(first, length):
        return F.concat_ws(" ", F.slice(F.col("words"), first, length))

    candidates = counts.df.filter("size >= 2").select("lang", "phrase", "size", F.col("f").alias("a"), words.alias("words"))
    cut = candidates.select(
        "lang", "phrase", "a", "size", "words", F.explode(F.sequence(F.lit(1), F.col("size") - 1)).alias("k")
    ).select(
        "lang", "phrase", "a", "k", part(F.lit(1), F.col("k")).alias("left"),
        part(F.col("k") + 1, F.col("size") - F.col("k")).alias("right"),
    )
    for side, count in (("left", "l"), ("right", "r")):
        found = staged.df.select("lang", F.col("phrase").alias(side), F.col("f").alias(count))
        cut = join_measured(cut, type(staged)(found, staged.rows, staged.bytes), ["lang", side])
    cut = join_measured(cut, totals, ["lang"])
    cut = cut.select(
        "lang", "phrase", "a", "k", "l", "r", "n",
        *[_exact(c).alias(f"x{c}") for c in ("a", "n", "l", "r")],
    )
    score = F.expr("cast(cast(1000 as decimal(4,0)) * xa * xn as decimal(38,0)) div (xl * xr)")
    best = cut.withColumn("score", score).groupBy("lang", "phrase", "a", "n").agg(
        F.min(F.struct("score", "k", "l", "r")).alias("best")
    )

    inner = candidates.filter("size >= 3").select(
        "lang", "a", "words", "size", F.explode(F.sequence(F.lit(2), F.col("size") - 1)).alias("length")
    ).select(
        "lang", "a", "words", "length", F.explode(F.sequence(F.lit(1), F.col("size") - F.col("length") + 1)).alias("at")
    ).select("lang", part(F.col("at"), F.col("length")).alias("phrase"), F.col("a").alias("longer"))
    longest = stage(inner.groupBy("lang", "phrase").agg(F.max("longer").alias("longer")), "longer-phrases")
    kept = join_measured(best, longest, ["lang", "phrase"], "left").filter(
        F.col("longer").isNull() | (F.col("longer") * 100 < F.col("a") * share)
    )
    return kept.select("lang", "phrase", "a", F.col("best.l").alias("l"), F.col("best.r").alias("r"), "n", F.col("best.score").alias("score"))


def collocations(docs: DataFrame, top: int = TOP, **limits: int) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: the best ``top`` phrases of every language."""
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = scored_phrases(docs, **limits).withColumn("rank", F.row_number().over(order))
    return ranked.filter(F.col("rank") <= top).select(
        "lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score"
    )


def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(documents(spark, sf_dir))


OP12_SQL = """
WITH d AS (
  SELECT coalesce(lang, 'und') AS lang, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t
  FROM documents
), pieces AS (
  SELECT lang, unnest(regexp_split_to_array(t, '[.,;:!?\\n\\x0B\\x0C\\r]')) AS p FROM d
), w AS (
  SELECT lang, list_filter(regexp_split_to_array(p, '[ \\t]+'), lambda x: x <> '') AS ws FROM pieces
), grams AS (
  SELECT lang, k, array_to_string(ws[i : i + k - 1], ' ') AS phrase
  FROM w, unnest([1, 2, 3, 4, 5]) AS s(k), unnest(range(1, len(ws) - k + 2)) AS u(i)
), f AS (
  SELECT lang, k, phrase, CAST(count(*) AS HUGEINT) AS f FROM grams GROUP BY ALL
), n AS (
  SELECT lang, sum(f) AS n FROM f WHERE k = 1 GROUP BY lang
), c AS (
  SELECT lang, k, phrase, f AS a, string_split(phrase, ' ') AS ws FROM f WHERE k >= 2 AND f >= 100
), cuts AS (
  SELECT lang, phrase, a, l.f AS l, r.f AS r, cut FROM (
    SELECT *, array_to_string(ws[1 : cut], ' ') AS lp, array_to_string(ws[cut + 1 : k], ' ') AS rp
    FROM c, unnest([1, 2, 3, 4]) AS s(cut) WHERE cut < k
  ) x JOIN (SELECT lang, phrase AS lp, f FROM f) l USING (lang, lp) JOIN (SELECT lang, phrase AS rp, f FROM f) r USING (lang, rp)
), scored AS (
  SELECT *, (1000 * a * n) // (l * r) AS score FROM cuts JOIN n USING (lang)
), best AS (
  SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1
), inner_parts AS (
  SELECT DISTINCT lang, array_to_string(ws[i : i + m - 1], ' ') AS phrase, a AS longer
  FROM c, unnest([2, 3, 4]) AS s(m), unnest([1, 2, 3, 4]) AS u(i) WHERE m < k AND i + m - 1 <= k
), kept AS (
  SELECT * FROM best b WHERE NOT EXISTS (
    SELECT 1 FROM inner_parts p WHERE p.lang = b.lang AND p.phrase = b.phrase AND 100 * p.longer >= 100 * b.a)
)
SELECT lang, rank, phrase, CAST(a AS BIGINT) AS a, CAST(l AS BIGINT) AS l, CAST(r AS BIGINT) AS r,
  CAST(n AS BIGINT) AS n, CAST(score AS BIGINT) AS score
FROM (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM kept)
WHERE rank <= 2000
"""
