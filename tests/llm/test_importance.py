import hashlib
import math
import random
import re
from collections import Counter
from zlib import crc32

import numpy as np
import pytest

from ledgerline.llm import importance
from ledgerline.llm.importance import NGrams, Shifts, bucket_counts, draw, op11_importance_resampling, ranked, scored

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
SCHEMA = "doc_id long, text string"


def words_of(text):
    return WORD.findall(re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))


def features_of(text, most=2):
    w = words_of(text)
    return [" ".join(w[i : i + k]) for k in range(1, most + 1) for i in range(len(w) - k + 1)]


def brute(docs, target, share=25, seed=7, buckets=10_000, min_words=20):
    def counts(texts):
        return Counter(crc32(f.encode()) % buckets for t in texts for f in features_of(t))

    s, t = counts(x for _, x in docs), counts(x for _, x in target)
    s_all, t_all = sum(s.values()), sum(t.values())

    def gain(b):
        return math.floor(1000 * math.log(((t[b] + 1.0) * (s_all + buckets)) / ((s[b] + 1.0) * (t_all + buckets))))

    rows = []
    for doc, text in docs:
        f = features_of(text)
        weight = sum(gain(crc32(x.encode()) % buckets) for x in f) // len(f) if f else 0
        h = int(hashlib.sha256(f"{seed}:{'' if doc is None else doc}".encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        rows.append([doc, len(f), weight, score, len(words_of(text)) >= min_words])
    able = sorted((r for r in rows if r[4]), key=lambda r: (-r[3], -math.inf if r[0] is None else r[0]))
    rank = {id(r): i + 1 for i, r in enumerate(able[: share * len(able) // 100])}
    return sorted(((*r[:4], rank.get(id(r))) for r in rows), key=repr)


def result(df):
    return sorted(map(tuple, df.collect()), key=repr)


@pytest.fixture(scope="module")
def corpus():
    rng = random.Random(3)
    names = ["alpha", "Beta", "gamma-ray", "Ünïcode", "x9", "日本", "it's", "END.", "mid\tdle", "k\x85l"]
    docs = [(i, " ".join(rng.choices(names, k=rng.randint(0, 60)))) for i in range(300)]
    docs += [(1000, None), (1001, ""), (1002, "!!! ---"), (None, "null id " * 20), (1003, "word " * 30_000)]
    target = [(i, "alpha gamma ray " * 3) for i in range(5)]
    return docs, target


def test_shift_of_any_length():
    rng = np.random.default_rng(1)
    lengths = np.array([0, 1, 255, 256, 257, 511, 65_535, 65_536, 70_001, (1 << 24) + 3])
    heads = [rng.bytes(9) for _ in lengths]
    moved = Shifts()(np.array([crc32(h) for h in heads], np.uint32), lengths)
    for head, n, got in zip(heads, lengths.tolist(), moved.tolist(), strict=True):
        assert got ^ crc32(bytes(n)) == crc32(head + bytes(n))


def test_crc_of_every_run_of_words():
    texts = [b"One two, THREE", b"", None, "ä 12 b".encode(), b"y" * 70_000 + b" tail end", b" lead"]
    counts, crcs, owner = NGrams(3).of(texts)
    for i, t in enumerate(texts):
        wanted = features_of((t or b"").decode(), 3)
        assert counts[i] == len(words_of((t or b"").decode()))
        assert sorted(crcs[owner == i].tolist()) == sorted(crc32(f.encode()) for f in wanted)


def test_equals_brute_force(spark, corpus, tmp_path):
    docs, target = corpus
    spark.createDataFrame(docs, SCHEMA).repartition(5).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(target, "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    df = op11_importance_resampling(spark, str(tmp_path))
    assert df.columns == ["doc_id", "n_features", "weight", "score", "rank"]
    assert {t for _, t in df.dtypes} == {"bigint"}
    assert result(df) == brute(docs, target)


def test_repeated_rows_are_ranked_one_by_one(spark):
    docs = [(5, "one two three " * 10)] * 8 + [(6, "four five six " * 10)] * 4
    rows = scored(spark.createDataFrame(docs, SCHEMA), spark.createDataFrame([], SCHEMA))
    got = ranked(rows.select("id", "n_words", "score"), share=50).collect()
    assert sorted(r["rank"] for r in got if r["rank"]) == [1, 2, 3, 4, 5, 6]
    assert len(got) == 12


def test_draw_keeps_all_columns_and_clashing_names(spark, corpus):
    docs, target = corpus
    rows = [(d, t, 1, "x", {"a": d or 0}) for d, t in docs]
    schema = SCHEMA + ", score int, own string, place map<string,long>"
    df = spark.createDataFrame(rows, schema)
    drawn = draw(df, spark.createDataFrame(target, SCHEMA))
    assert drawn.columns == df.columns
    wanted = sorted((r[0] for r in brute(docs, target) if r[4] is not None), key=repr)
    assert sorted((r["doc_id"] for r in drawn.collect()), key=repr) == wanted


def test_empty_tables(spark):
    none = spark.createDataFrame([], SCHEMA)
    some = spark.createDataFrame([(1, "a b c " * 10), (2, None)], SCHEMA)
    assert draw(none, some).collect() == []
    assert scored(none, none).collect() == []
    assert bucket_counts(none).collect() == []
    assert scored(some, none).count() == 2


def test_gains_with_few_buckets(spark):
    df = spark.createDataFrame([(1, "a a b"), (2, "c")], SCHEMA)
    counts = {r["bucket"]: r["n"] for r in bucket_counts(df, 1, 4).collect()}
    assert counts == dict(Counter(crc32(w) % 4 for w in (b"a", b"a", b"b", b"c")))
    gain = importance.gains(bucket_counts(df, 1, 4), bucket_counts(df, 1, 4), 4)
    assert gain.tolist() == [0, 0, 0, 0]
