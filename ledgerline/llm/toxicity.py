"""Toxicity scores: boosted trees over dense features of a text, calibrated by isotonic regression.

Learning reads labelled documents only, at most about ``SAMPLE_ROWS`` of them (a bound on the fit; every
document is scored). Their ids are dealt by hash: most teach the lexicon and the trees, the rest the
calibration. The lexicon holds words and word beginnings that occur in more toxic documents than
chance allows, by the likelihood ratio of their document counts in toxic and clean ones. Features are
computed in one Arrow pass per document: densities of lexicon words and beginnings, their weights,
distance to second-person words, capitals, punctuation, and letters hidden by digits or signs. Trees and
calibration are Spark ML models, fitted and applied by Spark.

Defined cases: a null text is empty; an empty text has zero features and its score like any other; a
null id is not held out; a null label, or one besides 0 and 1, teaches nothing; an id with several
labels counts as toxic if one says so. Without rows of both labels to learn from, every score is the
smoothed share of toxic rows (0.5 without any). Repeated rows score alike. Very long texts are read
whole. An empty table gives an empty result. Other columns pass through ``with_scores``.
"""

from __future__ import annotations

import math
import unicodedata
from collections import Counter
from dataclasses import dataclass

import numpy as np
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import IsotonicRegression
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.llm.common import Remember, ddl, documents, in_slices, stage, table

#: Bounds of the fit.
SAMPLE_ROWS = 20_000
LEXICON_TERMS = 300
#: A term needs this many toxic documents, this likelihood ratio (Dunning's G2), and this share of toxic
#: documents among those that hold it.
TERM_DOCS, TERM_RATIO, TERM_PRECISION = 3, 15.0, 0.7
BEGINNINGS = (4, 5, 6)
#: Of so many parts of the sample, which teach what.
PARTS = 7
LEXICON_PARTS, TREE_PARTS, CALIBRATION_PARTS = (0, 1, 2, 3, 4), (0, 1, 2, 3, 4), (5, 6)
TREES, DEPTH = 15, 4
THRESHOLD = 0.7

#: Words that address the reader, in the languages of the corpus.
SECOND_PERSON = frozenset(
    "you your yours yourself u ur du dich dir dein deine deinen deiner ihr euch euer "
    "tu te toi ton ta tes vous votre vos ti tus tuyo tuya usted ustedes vosotros".split()
)
#: Signs and digits that stand for letters.
STAND_INS = str.maketrans({"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "@": "a", "$": "s", "!": "i", "|": "l", "€": "e"})

_CAPS, _SECOND, _HIDDEN, _WORD, _START, _BARED, _LETTERS = (1 << i for i in range(7))
_TERM, _UPPER, _SIGNS, _SIZE = 8, 24, 34, 44
#: A token whose numbers do not fit beside the flags; they are counted where it occurs.
_LONG = 1 << 60


def _letters(token: str) -> str:
    return "".join(c for c in token if c.isalpha())


def _numbers(token: str) -> tuple[int, int, int]:
    """Capitals, signs and characters."""
    return sum(map(str.isupper, token)), sum(not c.isalnum() for c in token), len(token)


def _plain(token: str) -> str:
    """Letters of a token, small, without the accents and format characters put between them."""
    return _letters(unicodedata.normalize("NFC", token)).lower()


def _bared(token: str) -> str:
    """What a token reads as when signs and digits inside it stand for letters."""
    return _letters(token.lower().translate(STAND_INS))


def terms_of(text: str) -> set[str]:
    """Words of a text, and beginnings of longer words marked by a star."""
    words = {_plain(t) for t in text.split()}
    words.discard("")
    return words | {w[:n] + "*" for w in words for n in BEGINNINGS if len(w) > n}


@dataclass(frozen=True)
class Lexicon:
    """Terms with their weights (log-odds)."""

    weights: dict[str, float]


class Features:
    """Dense features of texts; remembers what it found out about a token."""

    def __init__(self, lexicon: Lexicon):
        self._terms = {t: i for i, t in enumerate(sorted(lexicon.weights))}
        self._weights = np.array([0.0, *(lexicon.weights[t] for t in sorted(lexicon.weights))])
        self._codes = Remember(self._code)

    def _term(self, word: str) -> tuple[int, int]:
        """1 + place of the heaviest term that a word is or begins with, and its kind."""
        found = self._terms.get(word)
        if found is not None:
            return found + 1, _WORD
        starts = [self._terms[s] + 1 for n in BEGINNINGS if len(word) > n and (s := word[:n] + "*") in self._terms]
        return (max(starts, key=lambda i: self._weights[i]), _START) if starts else (0, 0)

    def _code(self, token: str) -> int:
        letters = sum(map(str.isalpha, token))
        upper, signs, size = _numbers(token)
        core = token.strip(".,;:!?\"'()[]-")
        hidden = any(c.isalpha() for c in core) and not all(c.isalpha() or c in "'’-" for c in core)
        plain = _plain(token)
        term, kind = self._term(plain)
        flags = kind | _HIDDEN * hidden | _CAPS * (letters > 1 and upper == letters) | _LETTERS * (letters > 0)
        flags |= _SECOND * (plain in SECOND_PERSON)
        if hidden and not term:
            term, kind = self._term(_bared(core))
            flags |= _BARED * (term > 0) | kind
        flags |= term << _TERM
        if upper > 0x3FF or signs > 0x3FF or size > 0xFFFF:
            return flags | _LONG
        return flags | upper << _UPPER | signs << _SIGNS | size << _SIZE

    NAMES = (
        "words", "hits", "hit_density", "distinct_hits", "word_density", "start_density", "weight_density",
        "heaviest", "bared_hits", "near_second", "second_density", "capital_words", "capital_rate",
        "sign_rate", "hidden_rate", "exclamations", "letterless", "spread",
    )

    def of(self, text: str | None) -> list[float]:
        tokens = (text or "").split()
        n = len(tokens)
        if not n:
            return [0.0] * len(self.NAMES)
        code = np.fromiter(map(self._codes.__getitem__, tokens), np.int64, n)
        term = code >> _TERM & 0xFFFF
        places = np.flatnonzero(term)
        hit_terms = term[places]
        weights = self._weights[hit_terms]
        kinds = code[places]
        second = np.flatnonzero(code & _SECOND)
        near = 0.0
        if len(places) and len(second):
            after = np.searchsorted(second, places)
            right = np.abs(second[np.minimum(after, len(second) - 1)] - places)
            left = np.abs(second[np.maximum(after - 1, 0)] - places)
            near = float(np.mean(1.0 / (1.0 + np.minimum(left, right))))
        upper, signs, size = (int((code >> at & most).sum()) for at, most in ((_UPPER, 0x3FF), (_SIGNS, 0x3FF), (_SIZE, 0xFFFF)))
        for i in np.flatnonzero(code & _LONG).tolist():
            more = _numbers(tokens[i])
            upper, signs, size = upper + more[0], signs + more[1], size + more[2]
        share = lambda flag: float(np.count_nonzero(code & flag)) / n
        return [
            math.log1p(n),
            math.log1p(len(places)),
            len(places) / n,
            float(len(np.unique(hit_terms))),
            float(np.count_nonzero(kinds & _WORD)) / n,
            float(np.count_nonzero(kinds & _START)) / n,
            float(weights.sum()) / n,
            float(weights.max(initial=0.0)),
            float(np.count_nonzero(kinds & _BARED)),
            near,
            share(_SECOND),
            share(_CAPS),
            upper / size,
            signs / size,
            share(_HIDDEN),
            (text or "").count("!") / size,
            1.0 - share(_LETTERS),
            float(places[-1] - places[0]) / n if len(places) else 0.0,
        ]


def held_out(key: str = "doc_id") -> Column:
    """Rows that no model may learn from."""
    crc = F.crc32(F.col(key).cast("string").cast("binary"))
    return F.coalesce(crc % 3 == 1, F.lit(False))


def training_rows(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """text, toxic and part of a bounded sample of labelled documents."""
    known = labels.filter(F.col("toxic").isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out())
    known = known.groupBy("doc_id").agg(F.max("toxic").cast("double").alias("toxic"))
    total = known.count()
    share = min(1.0, sample_rows / max(1, total))
    place = F.pmod(F.xxhash64(F.lit(7), "doc_id"), F.lit(1_000_000))
    sample = known.filter(place < int(share * 1_000_000)).withColumn(
        "part", F.pmod(F.xxhash64(F.lit(77), "doc_id"), F.lit(PARTS)).cast("int")
    )
    texts = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    return texts.join(F.broadcast(sample), "doc_id").select("text", "toxic", "part")


def learn_lexicon(rows: DataFrame, limit: int = LEXICON_TERMS) -> Lexicon:
    """Terms of toxic documents, each with the log-odds of a toxic against a clean document."""
    counts = {r["toxic"]: r["n"] for r in rows.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    toxic, clean = counts.get(1.0, 0), counts.get(0.0, 0)
    if not toxic or not clean:
        return Lexicon({})

    def counted(part: DataFrame, wanted: frozenset | None) -> DataFrame:
        def run(batches):
            import pyarrow as pa

            found: Counter = Counter()
            for batch in batches:
                for text in batch.column("text").to_pylist():
                    terms = terms_of(text)
                    found.update(terms if wanted is None else terms & wanted)
            yield pa.RecordBatch.from_pydict({"term": pa.array(found.keys(), pa.string()), "n": pa.array(found.values(), pa.int64())})

        return part.select("text").mapInArrow(run, "term string, n bigint").groupBy("term").agg(F.sum("n").alias("n"))

    often = counted(rows.filter("toxic = 1"), None).filter(F.col("n") >= max(TERM_DOCS, toxic // 200))
    in_toxic = {r["term"]: r["n"] for r in often.collect()}
    in_clean = {r["term"]: r["n"] for r in counted(rows.filter("toxic = 0"), frozenset(in_toxic)).collect()}
    scored = []
    for term, t in in_toxic.items():
        c = in_clean.get(term, 0)
        ratio = _likelihood_ratio(t, c, toxic, clean)
        if ratio >= TERM_RATIO and t / (t + c) >= TERM_PRECISION:
            odds = math.log((t + 0.5) / (toxic - t + 0.5)) - math.log((c + 0.5) / (clean - c + 0.5))
            scored.append((ratio, term, odds))
    scored.sort(key=lambda s: (-s[0], s[1]))
    return Lexicon({term: odds for _, term, odds in scored[:limit]})


def _likelihood_ratio(t: int, c: int, toxic: int, clean: int) -> float:
    """G2 of a term's document counts against equal shares in toxic and clean documents."""
    share = (t + c) / (toxic + clean)
    cells = ((t, toxic * share), (c, clean * share), (toxic - t, toxic * (1 - share)), (clean - c, clean * (1 - share)))
    return 2 * sum(n * math.log(n / expected) for n, expected in cells if n)


def with_features(docs: DataFrame, lexicon: Lexicon, text: str = "text") -> DataFrame:
    """Adds ``features``, an array of numbers in the order of ``Features.NAMES``."""
    shared = docs.sparkSession.sparkContext.broadcast(lexicon)
    kept = [c for c in docs.columns if c != "features"]

    def make():
        features = Features(shared.value)

        def work(rows):
            return {"features": [features.of(t) for t in rows[text]]}

        return work

    return in_slices(docs.select(*kept), make, ddl(docs, kept) + ", features array<double>", use=[text])


@dataclass(frozen=True)
class Model:
    lexicon: Lexicon
    prior: float
    steps: _Steps | None

    def score(self, docs: DataFrame) -> DataFrame:
        """Adds ``score`` between 0 and 1."""
        if self.steps is None:
            return docs.withColumn("score", F.lit(self.prior))
        kept = [F.col(f"`{c}`") for c in docs.columns if c != "score"]
        own = docs.select(F.struct(*kept).alias("own"), F.col("text").alias("text"))
        vectors = with_features(own, self.lexicon).select("own", array_to_vector("features").alias("features"))
        scored = self.steps.transform(vectors)
        return scored.select("own.*", F.least(F.greatest("score", F.lit(0.0)), F.lit(1.0)).alias("score"))


def fit(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS) -> Model:
    rows = stage(training_rows(docs, labels, sample_rows), "labelled-texts").df
    lexicon = learn_lexicon(rows.filter(F.col("part").isin(*LEXICON_PARTS)))
    numbers = [F.col("features")[i].alias(n) for i, n in enumerate(Features.NAMES)]
    known = stage(with_features(rows, lexicon).select("toxic", "part", *numbers), "labelled-features", gather=True).df
    counts = {(r["part"], r["toxic"]): r["n"] for r in known.groupBy("part", "toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    toxic, total = sum(n for (_, x), n in counts.items() if x == 1), sum(counts.values())
    prior = (toxic + 0.5) / (total + 1)

    def both_labels(parts) -> bool:
        return all(any((p, x) in counts for p in parts) for x in (0.0, 1.0))

    if not both_labels(TREE_PARTS):
        return Model(lexicon, prior, None)
    # The sample is bounded, so two partitions hold it at any size of the corpus.
    vectors = known.select("toxic", "part", array_to_vector(F.array(*Features.NAMES)).alias("features")).coalesce(2).cache()
    trees = GBTClassifier(
        featuresCol="features", labelCol="toxic", predictionCol="label",
        maxIter=TREES, maxDepth=DEPTH, stepSize=0.3, maxBins=32, seed=7, minInstancesPerNode=3,
    ).fit(vectors.filter(F.col("part").isin(*TREE_PARTS)))
    isotonic = None
    if both_labels(CALIBRATION_PARTS):
        chances = _chance(trees.transform(vectors.filter(F.col("part").isin(*CALIBRATION_PARTS))))
        isotonic = IsotonicRegression(featuresCol="chance", labelCol="toxic", predictionCol="score").fit(chances)
    vectors.unpersist()
    return Model(lexicon, prior, _Steps(trees, isotonic))


class _Steps:
    """Trees, then calibration."""

    def __init__(self, trees, isotonic):
        self._trees, self._isotonic = trees, isotonic

    def transform(self, vectors: DataFrame) -> DataFrame:
        chances = _chance(self._trees.transform(vectors))
        if self._isotonic is None:
            return chances.withColumnRenamed("chance", "score")
        return self._isotonic.transform(chances)


def _chance(predicted: DataFrame) -> DataFrame:
    return predicted.withColumn("chance", vector_to_array("probability")[1])


def with_scores(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents with ``score`` and ``predicted`` (1 from ``THRESHOLD`` on)."""
    scored = fit(docs, labels).score(docs)
    return scored.withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "text")
    scored = with_scores(docs, table(spark, sf_dir, "labels"))
    return scored.select("doc_id", held_out().alias("held_out"), "score", "predicted")
