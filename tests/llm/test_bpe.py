"""Encoding and decoding against the public library, and the cases without text."""

import hashlib

import numpy as np
import pytest
from tokenizers import Tokenizer

from ledgerline.llm import bpe

WORDS = bpe.vocabulary_path("word_bpe_49k.json")
BYTES = bpe.vocabulary_path("byte_bpe_50k.json")
TEXTS = [
    "Hello  WORLD's Ünïcode 12 a<|endoftext|>b",
    "a\x1cb c\x85d e's  İΣΑΣ ﬁ 'S don't I'LL İ 12½ ²",
    "",
    "<|startoftext|>",
    " ",
    "日本語 テキスト\n\n😀😀 x y \t z é",
    "thonre, thonre. ''d 'd've !!?",
    "x" * 5000,
]


@pytest.fixture(scope="module")
def codecs():
    return {p: bpe.Codec(open(p, encoding="utf-8").read()) for p in (WORDS, BYTES)}


@pytest.mark.parametrize("path", [WORDS, BYTES])
def test_as_the_library(codecs, path):
    library = Tokenizer.from_file(path)
    for text in TEXTS:
        ids = library.encode(text, add_special_tokens=False).ids
        packed = codecs[path].encode(text)
        assert np.frombuffer(packed, "<u4").tolist() == ids
        assert codecs[path].decode(packed) == library.decode(ids, skip_special_tokens=False)


def test_lowest_rank_first_and_stale_entries():
    # a=0 b=1 c=2, ab=3, bc=4, abc=5; bc has the lower rank, so ab never comes to be.
    merges = [(1, 2, 4), (0, 1, 3), (0, 4, 5)]
    ranks = {a * 6 + b: r for r, (a, b, _) in enumerate(merges)}
    assert bpe.merge_symbols([0, 1, 2], ranks, merges, 6) == [5]
    assert bpe.merge_symbols([0, 1, 1, 2], ranks, merges, 6) == [3, 4]
    same = [(0, 0, 3)]
    assert bpe.merge_symbols([0, 0, 0], {0: 0}, same, 6) == [3, 0]
    assert bpe.merge_symbols([0], {0: 0}, same, 6) == [0]


def test_round_trip_over_rows(spark):
    rows = [(i, t) for i, t in enumerate(TEXTS)] + [(None, "a b"), (3, None), (0, TEXTS[0])]
    got = bpe.round_trip(spark.createDataFrame(rows, "doc_id long, text string"), WORDS).collect()
    library = Tokenizer.from_file(WORDS)
    want = []
    for i, t in rows:
        ids = library.encode(t or "", add_special_tokens=False).ids
        text = library.decode(ids, skip_special_tokens=False)
        want.append((i, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(text.encode()).hexdigest()))
    assert sorted(map(repr, map(tuple, got))) == sorted(map(repr, want))


def test_columns_and_empty_table(spark):
    df = spark.createDataFrame([("The cat", 7, [1], "x")], "text string, n_tokens int, ids array<int>, `a b` string")
    encoded = bpe.encode(df, WORDS, digests=True)
    assert encoded.columns == ["text", "a b", "n_tokens", "ids", "ids_sha256", "decoded_sha256"]
    row = bpe.decode(encoded, WORDS).collect()[0]
    assert (row["n_tokens"], row["a b"], row["decoded"]) == (2, "x", "the</w> cat</w>")
    assert bpe.encode(df.limit(0), WORDS).count() == 0
    assert bpe.decode(spark.createDataFrame([(None,)], "ids array<int>"), WORDS).collect()[0]["decoded"] == ""


def test_cache_forgets_only_what_is_old():
    known = bpe.Remember(str.upper, limit=2)
    assert [known[x] for x in "abcabc"] == list("ABCABC")
    assert len(known) <= 2


def test_short_words_merge_as_with_the_queue(codecs, monkeypatch):
    codec, rng = codecs[BYTES], np.random.default_rng(10)
    for n in range(bpe.SHORT_WORD + 1):
        for _ in range(20):
            symbols = [codec._inner[b] for b in rng.choice(list(b"aeeinst rth"), n)]
            short = bpe._merge_short(symbols, codec._ranks, codec._merges, codec._size)
            with monkeypatch.context() as m:
                m.setattr(bpe, "SHORT_WORD", -1)
                assert short == bpe.merge_symbols(symbols, codec._ranks, codec._merges, codec._size)


def test_spaces_are_told_as_by_the_pattern(codecs):
    letters = [" ", "\n", "a", ".", "\t", "\r", "\x0b", "\x1c", "\x1f", "\x85", "\xa0", "é"]
    for text in (a + b + c for a in letters for b in letters for c in letters):
        assert bpe._has_uneven_space(text) == bool(bpe._UNEVEN_SPACE.search(text))
        pieces = codecs[BYTES]._find.findall(text)
        assert codecs[BYTES].token_lengths(text).sum() == sum(len(p.encode()) for p in pieces)
