import hashlib
import random

import numpy as np
import pytest

from ledgerline.llm import suffix_dedup
from ledgerline.llm.suffix_dedup import dedup, op13_suffix_dedup, spans, with_kept

SCHEMA = "doc_id long, text string"


def brute(docs, length=100):
    """doc_id, n_bytes, n_removed, n_spans, kept of every row, by trying every string."""
    order = sorted({(-(2**63) if d is None else d, (t or "").encode()) for d, t in docs})
    seen, cut = set(), {}
    for d, data in order:
        gone, new = np.zeros(len(data) + 1, bool), []
        for i in range(len(data) - length + 1):
            part = data[i : i + length]
            if part in seen:
                gone[i : i + length] = True
            seen.add(part)
        gone = gone[:-1]
        starts = int((gone[1:] & ~gone[:-1]).sum()) + int(len(gone) > 0 and gone[0])
        cut[d, data] = (len(data), int(gone.sum()), starts, bytes(np.frombuffer(data, np.uint8)[~gone]))
    return sorted(((d, *cut[-(2**63) if d is None else d, (t or "").encode()]) for d, t in docs), key=repr)


def result(spark, docs, length=100, segment=suffix_dedup.SEGMENT):
    df = with_kept(spark.createDataFrame(docs, SCHEMA).repartition(3), length, segment=segment)
    rows = df.select("own.doc_id", "n_bytes", "n_removed", "n_spans", "kept").collect()
    return sorted(((r[0], r[1], r[2], r[3], bytes(r[4])) for r in rows), key=repr)


def text_of(rng, n):
    return "".join(rng.choice("abcdefgh é日") for _ in range(n))


@pytest.fixture(scope="module")
def docs():
    rng = random.Random(11)
    passages = [text_of(rng, rng.randint(60, 400)) for _ in range(6)]
    out = []
    for i in range(150):
        parts = [rng.choice([text_of(rng, rng.randint(0, 120)), rng.choice(passages), rng.choice(passages)[7:-5]]) for _ in range(5)]
        out.append((i * 3, "".join(parts)))
    out += [(7, "a" * 350), (8, "a" * 99), (1, "ab" * 200), (2, "ab" * 49 + "a"), (4, None), (5, ""), (None, passages[0])]
    out += [(1000 + i, passages[1] + passages[2]) for i in range(40)]
    return out


def test_equals_brute_force(spark, docs):
    assert result(spark, docs) == brute(docs)


@pytest.mark.parametrize("length", [2, 7, 33, 101])
def test_other_lengths(spark, docs, length):
    some = [(d, t[:200] if t else t) for d, t in docs[::6]] + docs[-12:]
    assert result(spark, some, length) == brute(some, length)


def test_few_letters(spark):
    rng = random.Random(2)
    docs = [(i, "".join(rng.choice("ab") for _ in range(rng.randint(0, 60)))) for i in range(40)]
    assert result(spark, docs, 8) == brute(docs, 8)


def test_long_texts_are_cut_into_segments(spark):
    rng = random.Random(4)
    base = text_of(rng, 3000)
    docs = [(1, base), (2, "x" + base[500:2500] + "y"), (3, base[::-1] + base[100:900]), (4, "z" * 1500)]
    groups = list(suffix_dedup._segments([1], [base.encode()], 100, 256))
    assert sum(len(p) - 99 for g in groups for _, _, p in g) == len(base.encode()) - 99
    assert result(spark, docs, segment=256) == brute(docs)


def test_same_id_and_repeated_rows(spark):
    rng = random.Random(6)
    a, b = text_of(rng, 300), text_of(rng, 300)
    same = result(spark, [(1, a), (1, a), (2, a), (2, a)])
    assert same == brute([(1, a), (1, a), (2, a), (2, a)])
    # Rows that share an id but not a text: the shared part stays in one of them.
    got = result(spark, [(1, a + b), (1, a + "tail")])
    assert sorted(r[2] for r in got) == [0, len(a.encode())]


def test_hot_runs_cross_tasks(spark):
    """A third of all rows hold one passage; runs of one name are cut over many tasks."""
    rng = random.Random(8)
    hot = text_of(rng, 160)
    docs = [(i, hot if i % 3 == 0 else text_of(rng, 150)) for i in range(900)]
    before = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        assert result(spark, docs) == brute(docs)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", before)


def test_query_and_columns(spark, docs, tmp_path):
    rows = [(d, t, i, "x", {"m": 1}) for i, (d, t) in enumerate(docs)]
    df = spark.createDataFrame(rows, SCHEMA + ", pos int, own string, runs map<string,int>")
    df.write.parquet(f"{tmp_path}/documents.parquet")
    got = op13_suffix_dedup(spark, str(tmp_path))
    assert got.columns == ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"]
    wanted = [(*r[:4], hashlib.sha256(r[4]).hexdigest()) for r in brute(docs)]
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(wanted, key=repr)
    out = dedup(df)
    assert out.columns == df.columns
    texts = sorted((r[0], r[4].decode("utf-8", "ignore")) for r in brute(docs) if r[0] is not None)
    assert sorted((r["doc_id"], r["text"] or "") for r in out.collect() if r["doc_id"] is not None) == texts


def test_empty_table(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert with_kept(none).collect() == []
    assert dedup(none).collect() == []


def test_spans_join_what_touches():
    starts, ends = spans(np.array([0, 100, 250]), np.array([1, 51, 1]), 100)
    assert (starts.tolist(), ends.tolist()) == ([0], [350])
    starts, ends = spans(np.array([0, 101]), np.array([1, 1]), 100)
    assert (starts.tolist(), ends.tolist()) == ([0, 101], [100, 201])
