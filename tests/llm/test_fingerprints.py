"""Fingerprints: equality, likeness, neighbours."""

import hashlib
import random

import pytest

from ledgerline.llm import fingerprints
from ledgerline.llm.common import Shingles

FOLDER = "/root/testdata/sf0.001"


def shingles(text):
    w = (text or "").encode().lower().split()
    return frozenset(tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))) if w else frozenset()


def jaccard(a, b):
    return len(a & b) / len(a | b) if a | b else 1.0


def corpus(n=120, seed=3):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(300)]
    texts = [" ".join(rng.choice(words) for _ in range(rng.choice([0, 1, 3, 5, 30, 400]))) for _ in range(n)]
    return texts + [texts[4], texts[4].upper(), None, "", " \t", "é" * 7]


def test_shingle_sets_as_tuples():
    texts = [t.encode() if t is not None else None for t in corpus()] + [b"x" * 10**6 + b" y", b"a b\x0cc\x0bd e f"]
    got = Shingles().of(texts)
    assert [len(h) for h in got] == [len(shingles((t or b"").decode())) for t in texts]
    assert len({x for h in got for x in h.tolist()}) == len({x for t in texts for x in shingles((t or b"").decode())})


def test_equal_texts_and_likeness():
    hasher = fingerprints.MinHash()
    texts = corpus()
    values = hasher.all_values([t.encode() if t is not None else None for t in texts])
    for i, a in enumerate(texts):
        for j, b in enumerate(texts):
            if shingles(a) == shingles(b):
                assert hasher.pack(values[i]) == hasher.pack(values[j]) and hasher.likeness(values[i], values[j]) == 1.0
            elif i < 30:
                assert hasher.likeness(values[i], values[j]) == pytest.approx(jaccard(shingles(a), shingles(b)), abs=0.12)
    packed = hasher.pack(values[5])
    assert hasher.unpack(packed) is None if not packed else hasher.unpack(packed).tolist() == values[5].tolist()


def test_low_order_bits_are_corrected():
    rng = random.Random(5)
    base = [f"t{i}" for i in range(2000)]
    other = base[:1000] + [f"u{rng.random()}" for _ in range(1000)]
    want = jaccard(shingles(" ".join(base)), shingles(" ".join(other)))
    for bins, bits in ((1024, 1), (512, 2), (512, 4), (256, 8)):
        hasher = fingerprints.MinHash(bins, bits)
        a, b = hasher.all_values([" ".join(base).encode(), " ".join(other).encode()])
        assert hasher.likeness(a, b) == pytest.approx(want, abs=0.1)


@pytest.mark.parametrize("bucket_rows", [4, 10_000])
def test_neighbours(spark, bucket_rows):
    texts = corpus()
    rows = [(i * 3 - 50, t, "x") for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, bucket string").repartition(6)
    got = {r["doc_id"]: r for r in fingerprints.compare_neighbours(docs, bucket_rows=bucket_rows).collect()}
    ordered = sorted(rows, key=lambda r: -r[0])
    assert len(got) == len(rows)
    for k, (doc, text, _) in enumerate(ordered):
        text, after = text or "", ordered[(k + 1) % len(ordered)][1] or ""
        half = len(text) // 2
        new = text[: len(text) - half] + after[:half]
        r = got[doc]
        assert (r["n_chars"], r["edited_sha256"]) == (len(text), hashlib.sha256(new.encode()).hexdigest())
        assert r["near_edited"] == pytest.approx(jaccard(shingles(text), shingles(new)), abs=0.15)
        assert r["near_next"] == pytest.approx(jaccard(shingles(text), shingles(after)), abs=0.15)


def test_ties_nulls_and_small_tables(spark):
    schema = "doc_id long, text string"
    rows = [(1, "b"), (1, "a"), (1, "a"), (None, "z z"), (2, None)]
    got = fingerprints.compare_neighbours(spark.createDataFrame(rows, schema), bucket_rows=1).collect()
    assert sorted((r["doc_id"] is None, r["doc_id"], r["n_chars"]) for r in got) == [(False, 1, 1)] * 3 + [(False, 2, 0), (True, None, 3)]
    single = fingerprints.compare_neighbours(spark.createDataFrame([(7, "abcd")], schema)).collect()
    assert [(r["edited_sha256"], r["near_next"]) for r in single] == [(hashlib.sha256(b"abab").hexdigest(), 1.0)]
    empty = spark.createDataFrame([], schema)
    assert fingerprints.compare_neighbours(empty).count() == 0 and fingerprints.fingerprints(empty).count() == 0


def test_hot_ids_and_equal_rows_spread(spark):
    rows = [(7, f"a{i} b c d e f") for i in range(600)] + [(3, "same same text")] * 600 + [(i, str(i)) for i in range(100, 700)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    sizes = [r["count"] for r in fingerprints.in_ranges(docs, bucket_rows=100).groupBy("range").count().collect()]
    assert sum(sizes) == len(rows) and max(sizes) < 300
    got = fingerprints.compare_neighbours(docs, bucket_rows=100).collect()
    assert sorted(r["doc_id"] for r in got) == sorted(r[0] for r in rows)
    same = "same same text"
    alike = hashlib.sha256((same[:7] + same[:7]).encode()).hexdigest()
    last = hashlib.sha256((same[:7] + "699").encode()).hexdigest()
    found = [r["edited_sha256"] for r in got if r["doc_id"] == 3]
    assert sorted(found) == sorted([alike] * 599 + [last])


def test_registered_query(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "text").collect()
    ordered = sorted(((r["doc_id"], r["text"] or "") for r in docs), reverse=True)
    want = {}
    for k, (doc, text) in enumerate(ordered):
        after = ordered[(k + 1) % len(ordered)][1]
        half = len(text) // 2
        new = text[: len(text) - half] + after[:half]
        want[doc] = (len(text), hashlib.sha256(new.encode()).hexdigest(), jaccard(shingles(text), shingles(new)))
    got = fingerprints.op1_fingerprint_documents(spark, FOLDER).collect()
    assert {r["doc_id"]: (r["n_chars"], r["edited_sha256"]) for r in got} == {d: w[:2] for d, w in want.items()}
    assert all(abs(r["near_edited"] - want[r["doc_id"]][2]) < 0.15 for r in got)


def test_fingerprint_column(spark):
    df = spark.createDataFrame([("a b c d e f", 1, "old"), (None, 2, "old")], "text string, `x y` int, fingerprint string")
    got = fingerprints.fingerprints(df).collect()
    assert [(r["x y"], len(r["fingerprint"])) for r in got] == [(1, 512), (2, 0)]
