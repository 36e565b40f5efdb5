"""Exact top-k against all inner products."""

import math
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerline.llm import topk


LONG = 2**63 - 1


def plain(rows, k, every):
    known = [
        (n, i, [math.floor(Fraction(float(np.float32(x))) * 1024) for x in v])
        for n, (i, v) in enumerate(rows)
        if i is not None and v and all(x is not None and math.isfinite(x) for x in v)
    ]
    out = []
    for m, q, x in known:
        if q % every == 0:
            scores = sorted((-sum(a * b for a, b in zip(x, y, strict=True)), i) for n, i, y in known if n != m and len(y) == len(x))
            out += [(q, r + 1, i, min(max(-s, -LONG), LONG)) for r, (s, i) in enumerate(scores[:k])]
    return sorted(out)


def asked(spark, rows, k=10, every=10, **how):
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    vectors = topk.quantised(df)
    got = topk.top_k(vectors, vectors.filter(F.col("id") % every == 0), k, **how)
    return sorted(map(tuple, got.collect()))


@pytest.mark.parametrize("block", [7, 100, 8192])
def test_as_all_pairs(spark, monkeypatch, block):
    monkeypatch.setattr(topk, "BLOCK_ROWS", block)
    monkeypatch.setattr(topk, "QUERY_ROWS", 3)
    rng = np.random.default_rng(block)
    rows = [(i, (rng.normal(size=8) / 3).tolist()) for i in range(300)]
    rows += [(1000 + i, rows[i % 20][1]) for i in range(40)]  # ties
    rows += [(2000, [0.0] * 8), (2001, None), (2002, [float("nan")] * 8), (2003, [None] * 8), (2010, [float("inf")] * 8)]
    rows += [(2020, []), (None, rows[0][1]), (2030, [1.0, -2.0]), (2031, [0.5, 3.0]), (2040, [1e9] * 8)]
    rows += [(2050, [3e38] * 8), (2060, [-3e38] * 8), (2061, [1e9, -1e9] * 4), (2070, [2e5] + [0.0] * 7), (2070, [2e5] + [0.0] * 7)]
    assert asked(spark, rows) == plain(rows, 10, 10)


def test_rows_that_share_an_id_are_candidates(spark):
    rows = [(0, [1.0, 0.0]), (0, [2.0, 0.0]), (1, [0.5, 0.0]), (10, [3.0, 1.0]), (10, [3.0, 1.0]), (10, [3.0, 1.0])]
    assert asked(spark, rows) == plain(rows, 10, 10)
    assert asked(spark, rows, 2) == plain(rows, 2, 10)


def test_many_queries_are_dealt(spark, monkeypatch):
    monkeypatch.setattr(topk, "DEAL_BYTES", 100)
    rng = np.random.default_rng(3)
    rows = [(i, rng.normal(size=4).tolist()) for i in range(200)] + [(i, [1.0, 2.0]) for i in range(9)]
    assert asked(spark, rows, 5, 3, limit=0) == plain(rows, 5, 3)


def test_clashing_columns(spark):
    rows = [(i, [float(i % 7), 1.0], i, "x") for i in range(30)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, id int, wide string")
    vectors = topk.quantised(df)
    got = topk.top_k(vectors, vectors.filter(F.col("id") % 10 == 0))
    assert sorted(map(tuple, got.collect())) == plain([r[:2] for r in rows], 10, 10)


def test_fewer_rows_than_k_and_repeated_ids(spark):
    rows = [(0, [1.0, 0.0]), (1, [2.0, 0.0]), (1, [2.0, 0.0]), (2, [-1.0, 5.0])]
    assert asked(spark, rows) == [(0, 1, 1, 2 * 1024**2), (0, 2, 1, 2 * 1024**2), (0, 3, 2, -(1024**2))]
    assert asked(spark, [(0, [1.0])]) == []
    assert asked(spark, []) == []


def test_sliced_sums_are_sums():
    rng = np.random.default_rng(1)
    x = rng.integers(-500, 500, size=(130, 5))
    index = topk.SlicedIndex(np.arange(130), x)
    query = np.array([3, -7, 0, 12, -1])
    slices = index.sums(query)
    got = np.zeros(130, np.int64)
    for j, s in enumerate(slices):
        got[index.rows_of(s)] += 1 << j
    high = (x - x.min(axis=0)) >> index.dropped
    top = (1 << (index.bits - index.dropped)) - 1
    want = np.where(query >= 0, query * high, -query * (top - high)).sum(axis=1)
    assert got.tolist() == want.tolist()
    exact = x @ query
    assert exact[index.top(query, 10)].tolist() == sorted(exact.tolist(), reverse=True)[:10]
