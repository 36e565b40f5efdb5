"""The law of the shards, gapless slots, and shuffles that lose nothing."""

import zlib
from collections import Counter

from pyspark.sql import functions as F

from ledgerline.llm import sharding


def docs_of(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string, shard string")


def checked(got, n_rows, shards=16):
    assert len(got) == n_rows
    for s in range(shards):
        slots = sorted(r["slot"] for r in got if r["shard"] == s)
        assert slots == list(range(len(slots)))
    of_key = {}
    for r in got:
        assert of_key.setdefault(r["doc_id"], r["shard"]) == r["shard"]


def test_shards(spark):
    rows = [(i, f"text {i} " * (i % 50), "x") for i in range(400)]
    rows += [(None, "same", "x")] * 150 + [(5, None, "y")] * 40 + [(6, "", "z"), (7, "long " * 200_000, "w")]
    docs = docs_of(spark, rows).repartition(7)
    placed = sharding.shards_of(docs.select("doc_id", "text"), bucket_bytes=4000)
    got = placed.withColumn("crc", F.crc32(F.coalesce("text", F.lit("")).cast("binary"))).collect()
    checked(got, len(rows))
    assert Counter((r["doc_id"], r["crc"]) for r in got) == Counter((i, zlib.crc32((t or "").encode())) for i, t, _ in rows)


def test_growth_takes_rows_only_into_the_new_shard(spark):
    ids = spark.range(2000)
    both = ids.select(sharding.shard_of(F.col("id"), 16).alias("a"), sharding.shard_of(F.col("id"), 17).alias("b")).collect()
    assert {r["b"] for r in both if r["a"] != r["b"]} == {16}
    assert min(Counter(r["a"] for r in both).values()) > 60


def test_order_is_shuffled_and_repeats(spark):
    docs = docs_of(spark, [(i, "t", "x") for i in range(300)]).select("doc_id", "text")
    runs = [{(r["doc_id"], r["shard"], r["slot"]) for r in sharding.shards_of(docs, shards=2).collect()} for _ in range(2)]
    assert runs[0] == runs[1]
    first = [i for i, s, _ in sorted(runs[0], key=lambda x: x[2]) if s == 0]
    assert first != sorted(first)


def test_empty_table_and_plan(spark):
    docs = docs_of(spark, []).select("doc_id", "text")
    assert sharding.shards_of(docs).count() == 0
    plan = sharding.scatter(docs_of(spark, [(1, "a", "x")]), 16, "doc_id", 1, 100)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_clashing_and_map_columns(spark):
    rows = [(i % 40, f"t{i % 11}", "x", {"a": i}, i) for i in range(300)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, shard string, m map<string,int>, __hash int")
    got = sharding.shards_of(docs, bucket_bytes=200).collect()
    checked(got, 300)
    assert sorted((r["m"]["a"], r["__hash"]) for r in got) == [(i, i) for i in range(300)]
    assert {f for r in got for f in r.asDict()} == {"doc_id", "text", "m", "__hash", "shard", "slot"}


def test_query_equals_the_law(spark, tmp_path):
    rows = [(i if i % 9 else None, [None, "", "é", f"text {i}"][i % 4]) for i in range(200)]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = sharding.op2_shard_documents(spark, str(tmp_path)).collect()
    assert got[0].asDict().keys() == {"doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard"}
    want = Counter((i, len((t or "").encode()) + 1, zlib.crc32((t or "").encode()), "key") for i, t in rows)
    assert Counter((r["doc_id"], r["size"], r["text_crc32"], r["law"]) for r in got) == want
    checked(got, 200)
    assert all(r["grown_shard"] in (r["shard"], 16) for r in got)
