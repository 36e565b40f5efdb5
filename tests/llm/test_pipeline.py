"""Every stage of the pipeline on its own input, and the run as a whole."""

import hashlib
from collections import Counter

import numpy as np
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from ledgerline.llm import bpe, mixing, ngram_join, toxicity

from .test_line_dedup import plain as plain_lines
from .test_ngram_join import plain as plain_groups
from .test_ngram_join import shingles
from .test_toxicity import corpus

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    docs, labels = corpus(240, 9)
    line = "a line that quite a few of the documents hold in common"
    rows = [(i, f"{line}\n{t}" if i % 9 == 1 else t, "en", f"s{i % 3}", 0) for i, t, _ in docs]
    rows += [(1000 + i, rows[i][1] + " tail", "en", None, 0) for i in range(1, 40)]
    rows += [(2000, None, "en", "s1", 0), (2001, "", None, "s2", 0), rows[5], rows[5]]
    rows = [(d, t, lang, s, len(t or "")) for d, t, lang, s, _ in rows]
    path = str(tmp_path_factory.mktemp("tables"))
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    return path


def test_stages(spark, folder):
    assert [n for n, _ in corpus_pipeline.STAGES] == [
        "toxicity", "line dedup", "n-gram Jaccard join", "mixing sources to target weights", "BPE encoding and decoding",
    ]
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    steps = [docs]
    for i, (_, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, steps[-1], folder)
        assert i == 4 or out.columns == COLUMNS
        out.write.parquet(f"{folder}/stage{i}")
        steps.append(spark.read.parquet(f"{folder}/stage{i}"))
    given, clean, lines, single, mixed, ids = ([tuple(r) for r in s.collect()] for s in steps)

    scored = toxicity.with_scores(docs, spark.read.parquet(f"{folder}/labels.parquet")).collect()
    assert Counter(map(repr, clean)) == Counter(repr(tuple(r)[:5]) for r in scored if not r["predicted"])
    assert len(given) > len(clean) > 0.6 * len(given)

    def counted(row, text):
        return (row[0], text, *row[2:4], row[4] if text is None else len(text))

    kept = plain_lines([(r[0], r[1]) for r in clean])
    assert Counter(map(repr, lines)) == Counter(repr(counted(r, None if r[1] is None else t)) for r, t in zip(clean, kept, strict=True))
    assert lines != clean

    groups = {c for _, n, c in plain_groups(lines)[0] if n}
    assert Counter(r[0] for r in single if shingles(r[1])) == Counter(groups)
    assert Counter(map(repr, (r for r in single if not shingles(r[1])))) == Counter(map(repr, (r for r in lines if not shingles(r[1]))))
    assert set(map(repr, single)) <= set(map(repr, lines)) and len(single) < len(lines)

    taken = Counter()
    for r in mixing.plan(steps[3]).collect():
        taken[r["__id"]] += r["taken"]
    assert Counter({k: n for k, n in taken.items() if n}) == +sum((Counter({r[0]: len((r[1] or "").split())}) for r in mixed), Counter())

    library = Tokenizer.from_file(bpe.vocabulary_path(corpus_pipeline.VOCABULARY))
    want = Counter()
    for doc, text, lang, source, _ in mixed:
        tokens = library.encode(text or "", add_special_tokens=False).ids
        back = library.decode(tokens, skip_special_tokens=False)
        want[repr((doc, lang, source, len(tokens), tokens, hashlib.sha256(np.array(tokens, "<u4").tobytes()).hexdigest(), hashlib.sha256(back.encode()).hexdigest()))] += 1
    assert Counter(map(repr, ids)) == want


def test_run_and_empty_tables(spark, folder, tmp_path):
    assert corpus_pipeline.run(spark, folder).count() > 50
    for name in ("documents", "labels"):
        spark.read.parquet(f"{folder}/{name}.parquet").limit(0).write.parquet(f"{tmp_path}/{name}.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def test_query_names():
    from ledgerline.llm import queries

    assert sorted(int(n[2:].split("_")[0]) for n in queries.QUERIES) == list(range(1, 14))
    assert ngram_join.PERCENT == 75
