"""Two-pass external shuffle into shards, with DataFrame functions only.

Pass 1 scatters: the shard of a row is the one with the highest seeded hash of (id, shard), so the id
and the number of shards decide, and one more shard takes rows only into itself. Inside its shard a
row goes to a bucket by another seeded hash; a shard has as many buckets as its bytes ask for, so a
bucket fits into memory whatever the size of the shard. Pass 2 gathers each bucket, puts it in a
fixed order, shuffles it by Fisher-Yates (Spark's seeded ``shuffle``) and writes it. Slots are the
position in the bucket plus the rows of the buckets before it, counted from what was written.

The bucket hash holds the row's number in the scan beside its content, so repeated rows or a null id
with a third of all rows spread over all buckets of their shard.

Defined cases: a null id hashes like one id of its own; a null text has size 1 and the checksum of
no bytes; repeated rows get slots of their own; an empty table gives an empty result. Other columns
of any type travel with their rows in ``shards_of``; its own ``shard`` and ``slot`` take the place of
columns of that name.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgerline.llm.common import documents, join_measured, new_shared_path, stage

SHARDS = 16
SEED = 20
BUCKET_BYTES = 4 * 1024 * 1024


def shard_of(key: Column, shards: int, seed: int = SEED) -> Column:
    """Highest-random-weight choice: the shard whose hash with the key is largest."""
    picks = [F.struct(F.xxhash64(F.lit(seed), key, F.lit(s)).alias("h"), F.lit(s).alias("s")) for s in range(shards)]
    return (F.greatest(*picks) if shards > 1 else picks[0])["s"]


def text_size(text: str = "text") -> Column:
    return F.coalesce(F.octet_length(text), F.lit(0)).cast("long") + 1


def scatter(df: DataFrame, shards: int, key: str, seed: int, bucket_bytes: int) -> DataFrame:
    """Pass 1: adds __shard and __bucket. Reads the sizes once; the result per shard is one number."""
    shard = shard_of(F.col(f"`{key}`"), shards, seed)
    sizes = df.select(shard.alias("s"), text_size().alias("n")).groupBy("s").agg(F.sum("n").alias("n"))
    buckets = {r["s"]: -(-r["n"] // bucket_bytes) for r in sizes.collect()}
    numbers = F.array(*[F.lit(buckets.get(s, 1)) for s in range(shards)])
    row = F.xxhash64(F.lit(seed + 1), F.col(f"`{key}`"), F.xxhash64("text"), F.monotonically_increasing_id())
    return (
        df.select(F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("__row"), shard.alias("__shard"), row.alias("__hash"))
        .withColumn("__bucket", F.pmod("__hash", F.element_at(numbers, F.col("__shard") + 1)).cast("int"))
    )


def write_shuffled(scattered: DataFrame, path: str, seed: int) -> DataFrame:
    """Pass 2: shuffles every bucket and writes it; gives back what was written, with __pos."""
    rows = F.collect_list(F.struct("__hash", "__row"))
    if "map<" in scattered.schema["__row"].dataType.simpleString():  # maps have no order

        def by_hash(a: Column, b: Column) -> Column:
            return F.when(a["__hash"] < b["__hash"], -1).when(a["__hash"] > b["__hash"], 1).otherwise(0)

        ordered = F.array_sort(rows, by_hash)
    else:
        ordered = F.sort_array(rows, asc=True)
    gathered = (
        scattered.repartition("__shard", "__bucket")
        .groupBy("__shard", "__bucket")
        .agg(ordered.alias("__rows"))
        .sortWithinPartitions("__shard", "__bucket")
    )
    shuffled = gathered.withColumn("__rows", F.shuffle("__rows", seed))
    rows = shuffled.select("__shard", "__bucket", F.posexplode("__rows").alias("__pos", "__entry"))
    rows.select("__shard", "__bucket", "__pos", F.col("__entry.__row").alias("__row")).write.parquet(path)
    return scattered.sparkSession.read.parquet(path)


def shards_of(
    df: DataFrame,
    shards: int = SHARDS,
    key: str = "doc_id",
    seed: int = SEED,
    bucket_bytes: int = BUCKET_BYTES,
    path: str | None = None,
) -> DataFrame:
    """All columns of every row, with ``shard`` and ``slot``; the records lie below ``path``."""
    spark = df.sparkSession
    written = write_shuffled(scatter(df, shards, key, seed, bucket_bytes), path or new_shared_path(spark, "shards"), seed)
    counts = written.groupBy("__shard", "__bucket").agg(F.count(F.lit(1)).alias("n"))
    earlier = Window.partitionBy("__shard").orderBy("__bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("__shard", "__bucket", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("__before"))
    own = [F.col("__row").getField(c).alias(c) for c in df.columns if c not in ("shard", "slot")]
    return join_measured(written, stage(offsets, "bucket-offsets", gather=True), ["__shard", "__bucket"]).select(
        *own, F.col("__shard").alias("shard"), (F.col("__before") + F.col("__pos")).alias("slot")
    )


def op2_shard_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = shards_of(documents(spark, sf_dir).select("doc_id", "text"))
    return placed.select(
        "doc_id",
        text_size().alias("size"),
        F.crc32(F.coalesce("text", F.lit("")).cast("binary")).alias("text_crc32"),
        F.lit("key").alias("law"),
        "shard",
        "slot",
        shard_of(F.col("doc_id"), SHARDS + 1).alias("grown_shard"),
    )
