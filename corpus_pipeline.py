"""Corpus pipeline: from the table of documents to token ids.

Toxic documents go, lines that many documents share stay in one, of each group of near duplicates one
document stays, sources are mixed to their target weights in curriculum order, and the mix is encoded.
Every stage takes (spark, docs, sf_dir) and returns a DataFrame; what it returns is written as Parquet
and read again as the next one's docs. All but the last return the columns of documents.

Documents that a stage does not reject are kept, empty ones included; the mix takes a document as often
as its source's target asks for, and not at all beyond it. Nulls, repeated rows and empty tables have
the results that the operators define.

All stages share executors whose workers live on, so what Spark hands to Python at a time is held to
``ARROW_BYTES`` (a larger text goes alone), unless the session has a bound of its own.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.llm import bpe, line_dedup, mixing, ngram_join, toxicity
from ledgerline.llm.common import documents, new_shared_path, table

VOCABULARY = "word_bpe_49k.json"
ARROW_BYTES = 2 * 1024 * 1024
_ARROW_BOUND = "spark.sql.execution.arrow.maxBytesPerBatch"


def _in_small_batches(spark: SparkSession) -> None:
    if spark.conf.get(_ARROW_BOUND, None) is None:
        spark.conf.set(_ARROW_BOUND, str(ARROW_BYTES))


def _counted(docs: DataFrame) -> DataFrame:
    """n_chars as the text has them now."""
    return docs.withColumn("n_chars", F.coalesce(F.length("text").cast("long"), F.col("n_chars")))


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    _in_small_batches(spark)
    scored = toxicity.with_scores(docs, table(spark, sf_dir, "labels"))
    return scored.filter("predicted = 0").select(*docs.columns)


def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    _in_small_batches(spark)
    return _counted(line_dedup.dedup_lines(docs))


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    _in_small_batches(spark)
    return ngram_join.one_of_each(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    _in_small_batches(spark)
    return _counted(mixing.mix_rows(docs).select("own.*"))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    _in_small_batches(spark)
    encoded = bpe.encode(docs, bpe.vocabulary_path(VOCABULARY), digests=True)
    return encoded.select("doc_id", "lang", "source", "n_tokens", "ids", "ids_sha256", "decoded_sha256")


STAGES = [
    ("toxicity", drop_toxic),
    ("line dedup", dedup_lines),
    ("n-gram Jaccard join", one_of_each),
    ("mixing sources to target weights", mix_sources),
    ("BPE encoding and decoding", encode),
]

#: Learned scores, hashed places in the mix and merges by rank are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for name, stage in STAGES:
        path = new_shared_path(spark, name.lower().replace(" ", "-"))
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
