"""Tokens attributed to sections, against the library's own encoding."""

import numpy as np
from tokenizers import Tokenizer

from ledgerline.llm import bpe, token_counts

PATH = bpe.vocabulary_path("byte_bpe_50k.json")
TEXTS = [
    "The first line.\nThe second line, longer.\n\n  indented\n",
    "",
    "\n",
    "one two  three   four\t\tfive",
    "日本語 テキスト😀😀\né x<|endoftext|>y",
    "word " * 3000,
]


def plain(text, spans):
    """Tokens per span: most bytes, then the earlier; by the library's tokens."""
    library = Tokenizer.from_file(PATH)
    library.encode_special_tokens = True
    place = np.r_[0, np.cumsum([len(c.encode()) for c in text])].astype(int)
    spans = [(place[a], place[b]) for a, b in spans]
    counts, outside, at = [0] * len(spans), 0, 0
    for i in library.encode(text, add_special_tokens=False).ids:
        end = at + len(library.id_to_token(i))
        held = [max(0, min(b, end) - max(a, at)) for a, b in spans]
        if any(held):
            counts[held.index(max(held))] += 1
        else:
            outside += 1
        at = end
    return counts, outside


def test_lines(spark):
    rows = [(i, t) for i, t in enumerate(TEXTS)] + [(None, None), (3, TEXTS[3])]
    got = token_counts.count_lines(spark.createDataFrame(rows, "doc_id long, text string"), PATH).collect()
    for doc, text in enumerate(TEXTS):
        mine = sorted((r for r in got if r["doc_id"] == doc), key=lambda r: r["section"])
        spans = [(r["start_char"], r["end_char"]) for r in mine][: len(text.split("\n"))]
        assert "".join(text[a:b] for a, b in spans) == text
        assert [r["n_tokens"] for r in mine][: len(spans)] == plain(text, spans)[0]
    empty = [r for r in got if r["doc_id"] is None]
    assert [(r["section"], r["start_char"], r["end_char"], r["n_tokens"]) for r in empty] == [(0, 0, 0, 0)]
    assert sum(r["doc_id"] == 3 for r in got) == 2


def test_spans_that_cut_tokens(spark):
    cases = [(t, [(i, min(i + 3, len(t))) for i in range(0, len(t), 4)]) for t in TEXTS[:5]]
    cases += [("abc def", [(0, 0), (0, 2), (2, 2), (2, 7)]), ("abc", []), ("hello world", [(0, 7), (7, 11)])]
    rows = [(i, t, [(int(a), int(b)) for a, b in s], "x") for i, (t, s) in enumerate(cases)] + [(99, "a b", None, "x")]
    df = spark.createDataFrame(rows, "doc_id long, text string, spans array<struct<start:int,end:int>>, tokens string")
    got = {r["doc_id"]: r for r in token_counts.count_spans(df, PATH).collect()}
    for i, (text, spans) in enumerate(cases):
        assert (got[i]["tokens"], got[i]["outside"]) == plain(text, spans)
    assert got[99]["tokens"] == [] and got[99]["outside"] == 2
    assert sum(got[len(cases) - 1]["crossing"]) == 1


def test_texts_that_begin_with_one_space(spark):
    texts = [" abc", " ", " abc def\nghi jkl", " \nx"]
    spans = [[(0, 1), (1, len(t))] for t in texts]
    rows = [(i, t, [(int(a), int(b)) for a, b in s]) for i, (t, s) in enumerate(zip(texts, spans, strict=True))]
    df = spark.createDataFrame(rows, "doc_id long, text string, spans array<struct<start:int,end:int>>")
    got = {r["doc_id"]: r for r in token_counts.count_spans(df, PATH).collect()}
    for i, text in enumerate(texts):
        assert (got[i]["tokens"], got[i]["outside"]) == plain(text, spans[i])
    lines = token_counts.count_lines(df.select("doc_id", "text"), PATH).collect()
    for i, text in enumerate(texts):
        mine = sorted((r["start_char"], r["end_char"], r["n_tokens"]) for r in lines if r["doc_id"] == i)
        assert [n for _, _, n in mine] == plain(text, [(a, b) for a, b, _ in mine])[0]
    fields = spark.createDataFrame([(1, " A title", "The body."), (2, " ", None)], "doc_id long, title string, body string")
    counted = token_counts.count_fields(fields, PATH, ["title", "body"]).collect()
    got = {(r["doc_id"], r["field"]): r["n_tokens"] for r in counted}
    assert [got[1, f] for f in ("title", "body")] == plain(" A title\nThe body.", [(0, 8), (9, 18)])[0]
    assert [got[2, f] for f in ("title", "body")] == plain(" \n", [(0, 1), (2, 2)])[0]


def test_allocation_rule():
    chosen, crosses = token_counts.allocate(np.array([4, 2, 5]), np.array([0, 5, 5, 9]), np.array([5, 5, 9, 10]))
    # 0-4 in the first; 4-6 half in each of two: the earlier; 6-11: most in the third
    assert chosen.tolist() == [0, 0, 2] and crosses.tolist() == [False, True, True]
    chosen, _ = token_counts.allocate(np.array([1, 1]), np.array([1]), np.array([2]))
    assert chosen.tolist() == [-1, 0]


def test_fields(spark):
    df = spark.createDataFrame([(1, "A title", None, "The body."), (2, None, None, None)], "doc_id long, title string, note string, body string")
    got = {(r["doc_id"], r["field"]): r["n_tokens"] for r in token_counts.count_fields(df, PATH, ["title", "note", "body"]).collect()}
    counts, _ = plain("A title\n\nThe body.", [(0, 7), (8, 8), (9, 18)])
    assert [got[1, f] for f in ("title", "note", "body")] == counts
    assert [got[2, f] for f in ("title", "note", "body")] == [0, 0, 0]
    assert token_counts.count_fields(df.limit(0), PATH, ["title"]).count() == 0
