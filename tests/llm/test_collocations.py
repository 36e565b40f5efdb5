import random
import re
from collections import Counter

import numpy as np
import pytest

from ledgerline.llm.collocations import collocations, frequent_pairs, op12_collocations, pair_map, phrase_counts, windows

SCHEMA = "doc_id long, text string, lang string"


def pieces_of(text):
    low = re.sub("[A-Z]", lambda m: m.group().lower(), text or "")
    return [re.findall(r"[^\x20\x09]+", p) for p in re.split(r"[.,;:!?\x0A-\x0D]", low)]


def counts_of(docs):
    f, n = Counter(), Counter()
    for _, text, lang in docs:
        lang = lang or "und"
        for ws in pieces_of(text):
            n[lang] += len(ws)
            for k in range(1, 6):
                f.update((lang, tuple(ws[i : i + k])) for i in range(len(ws) - k + 1))
    return f, n


def brute(docs, min_count=100, top=2000):
    f, n = counts_of(docs)
    candidates = {key: a for key, a in f.items() if len(key[1]) > 1 and a >= min_count}
    longest = Counter()
    for (lang, ws), a in candidates.items():
        for k in range(2, len(ws)):
            for i in range(len(ws) - k + 1):
                longest[lang, ws[i : i + k]] = max(longest[lang, ws[i : i + k]], a)
    rows = {}
    for (lang, ws), a in candidates.items():
        if 100 * longest[lang, ws] >= 100 * a:
            continue
        score, _, left, right = min(
            (1000 * a * n[lang] // (f[lang, ws[:k]] * f[lang, ws[k:]]), k, f[lang, ws[:k]], f[lang, ws[k:]])
            for k in range(1, len(ws))
        )
        rows.setdefault(lang, []).append((-score, -a, " ".join(ws).encode(), left, right))
    out = []
    for lang, found in rows.items():
        for rank, (score, a, phrase, left, right) in enumerate(sorted(found)[:top], 1):
            out.append((lang, rank, phrase.decode(), -a, left, right, n[lang], -score))
    return sorted(out)


@pytest.fixture(scope="module")
def docs():
    rng = random.Random(5)
    names = ["new", "york", "City", "the", "of", "état", "日本", "a b", "x"]
    out = []
    for i in range(400):
        words = []
        for _ in range(rng.randint(0, 40)):
            words.append(rng.choice(["New York city", "the end of the", rng.choice(names), f"rare{rng.randint(0, 500)}"]))
            words.append(rng.choice([" ", " ", "  ", "\t", ", ", ".", "\n", " \x0b", "!?"]))
        out.append((i, "".join(words), rng.choice(["en", "en", "fr", None, "und", "ä"])))
    return out + [(900, None, "en"), (901, "", None), (902, " \t.,", "fr"), (903, "new york " * 20_000, "en")] + [(1, "so it goes on", "en")] * 120


def result(df):
    return sorted(map(tuple, df.collect()))


def test_equals_brute_force(spark, docs, tmp_path):
    spark.createDataFrame(docs, SCHEMA).repartition(4).write.parquet(f"{tmp_path}/documents.parquet")
    df = op12_collocations(spark, str(tmp_path))
    assert df.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    wanted = brute(docs)
    assert len(wanted) > 10
    assert result(df) == wanted


@pytest.mark.parametrize(("min_count", "top"), [(2, 2000), (30, 3), (1, 50)])
def test_other_limits(spark, docs, min_count, top):
    some = docs[:60]
    df = spark.createDataFrame(some, SCHEMA)
    assert result(collocations(df, top=top, min_count=min_count)) == brute(some, min_count, top)


def test_a_full_map_of_pairs_changes_nothing(spark, docs):
    df = spark.createDataFrame(docs[:100], SCHEMA)
    every = np.full(8, 255, np.uint8)
    tight = pair_map(frequent_pairs(df, 20), 1 << 20)

    def counts(bits):
        return sorted((r["lang"], tuple(r["words"]), r["f"]) for r in phrase_counts(windows(df, bits), min_count=20).collect())

    assert counts(every) == counts(tight)
    f, n = counts_of(docs[:100])
    wanted = [(lang, ws, c) for (lang, ws), c in f.items() if c >= 20] + [(lang, (), c) for lang, c in n.items() if c]
    assert counts(every) == sorted(wanted)


def test_columns_that_clash_and_empty_tables(spark, docs):
    rows = [(*d, 1, "z") for d in docs[:80]]
    df = spark.createDataFrame(rows, SCHEMA + ", n int, w1 string")
    assert result(collocations(df, min_count=10)) == brute(docs[:80], 10)
    assert collocations(spark.createDataFrame([], SCHEMA)).collect() == []


def test_products_beyond_64_bits(spark):
    """Scores go through decimals: the same formula on counts whose product passes 64 bits."""
    row = spark.range(1).selectExpr(
        "cast(4000000000000 as decimal(38,0)) as xa", "cast(9000000000000 as decimal(38,0)) as xn",
        "cast(5000000000000 as decimal(38,0)) as xl", "cast(7000000000001 as decimal(38,0)) as xr",
    ).selectExpr("cast(cast(1000 as decimal(4,0)) * xa * xn as decimal(38,0)) div (xl * xr) as s")
    assert row.collect()[0]["s"] == 1000 * 4000000000000 * 9000000000000 // (5000000000000 * 7000000000001)
