"""Line dedup against a plain simulation."""

import collections
import random

import pytest

from ledgerline.llm import line_dedup

SCHEMA = "doc_id long, text string, lang string, keep string"


def key(line):
    return line.strip(" \t\n\r\x0b\x0c").translate({i: i + 32 for i in range(65, 91)})


def plain(rows, min_chars=40, min_docs=5):
    ids = [-(2**63) if d is None else d for d, *_ in rows]
    holders = collections.defaultdict(set)
    for d, (_, text, *_) in zip(ids, rows, strict=True):
        for line in (text or "").split("\n"):
            if len(key(line)) >= min_chars:
                holders[key(line)].add(d)
    common = {k: max(h) for k, h in holders.items() if len(h) >= min_docs}
    return [
        "\n".join(x for x in (text or "").split("\n") if common.get(key(x), d) == d)
        for d, (_, text, *_) in zip(ids, rows, strict=True)
    ]


def corpus(seed):
    rng = random.Random(seed)
    shared = [f"Shared LINE number {i} with some more words äöü" for i in range(6)] + ["short", "é" * 40, "é" * 39]
    rows = []
    for i in range(60):
        lines = [rng.choice(shared) if rng.random() < 0.6 else f"own line {i} {j} that nobody else has at all" for j in range(rng.randint(0, 9))]
        lines = [" " * rng.randint(0, 2) + (x.upper() if rng.random() < 0.2 and x.isascii() else x) + rng.choice(["", "\t", "\r"]) for x in lines]
        rows.append((rng.choice([i, i, i, None, 7]), "\n".join(lines), "en", "k"))
    return [*rows, rows[0], rows[0], (99, None, "x", "k"), (98, "", "x", "k"), (97, "\n\n", "x", None)]


@pytest.mark.parametrize("hot_rows", [3, 10**6])
def test_as_the_simulation(spark, hot_rows):
    rows = corpus(hot_rows)
    docs = spark.createDataFrame(rows, SCHEMA)
    got = line_dedup.dedup_lines(docs, hot_rows=hot_rows).collect()
    want = [(d, None if t is None else k, *rest) for (d, t, *rest), k in zip(rows, plain(rows), strict=True)]
    assert sorted(map(repr, map(tuple, got))) == sorted(map(repr, want))
    assert sum(len(t or "") for _, t, *_ in rows) > sum(len(t) for t in plain(rows))


def test_digest_counts_lines(spark):
    line = "a line of at least forty characters, so it counts"
    rows = [(i, f"{line}\nown {i}\n{line.upper()} ", None, None) for i in range(5)]
    docs = spark.createDataFrame(rows, SCHEMA)
    got = line_dedup.digest(docs, line_dedup.stage(line_dedup.keep_bitmaps(docs), "t"))
    assert {r["doc_id"]: (r["n_lines"], r["n_dropped"]) for r in got.collect()} == {0: (3, 2), 1: (3, 2), 2: (3, 2), 3: (3, 2), 4: (3, 0)}


def test_four_documents_are_too_few_and_empty_table(spark):
    rows = [(i % 4, "x" * 50, None, None) for i in range(12)]
    docs = spark.createDataFrame(rows, SCHEMA)
    assert line_dedup.keep_bitmaps(docs).count() == 0
    assert line_dedup.dedup_lines(docs.limit(0)).count() == 0


def test_bitmaps():
    packed = line_dedup.pack([1, 9], 11)
    assert line_dedup.unpack(packed, 11).tolist() == [i not in (1, 9) for i in range(11)]


def test_clashing_and_map_columns_and_a_long_text(spark):
    line = "a line of at least forty characters, so it counts"
    long = "\n".join([line, *(f"own line {i}" for i in range(40_000))])
    rows = [(i, f"{line}\nown {i}", "x", 1, {"a": i}) for i in range(5)] + [(9, long, None, None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, __keep string, kept int, keep map<string,int>")
    out = line_dedup.dedup_lines(docs)
    assert out.columns == docs.columns
    got = {r["doc_id"]: r for r in out.collect()}
    assert got[9]["text"] == long and got[3]["text"] == "own 3" and got[3]["keep"] == {"a": 3} and got[3]["kept"] == 1
