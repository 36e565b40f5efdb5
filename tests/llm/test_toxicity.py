"""Features, learning limits and held-out accuracy."""

import random
import zlib

import pytest

from ledgerline.llm import toxicity

LABELS = "doc_id long, quality int, toxic int"


def corpus(n=400, seed=2):
    rng = random.Random(seed)
    words = [f"{a}{b}{c}" for a in "bdfg" for b in "aeio" for c in ("lan", "mer", "tos", "vin")]
    bad = ["scoundrel", "nitwit", "dolt"]
    docs, labels = [], []
    for i in range(n):
        text = [rng.choice(words) for _ in range(rng.randint(5, 80))]
        toxic = i % 4 == 0
        if toxic:
            for _ in range(rng.randint(2, 5)):
                text.insert(rng.randrange(len(text)), rng.choice(bad) if rng.random() < 0.8 else rng.choice(bad).replace("o", "0"))
        docs.append((i, " ".join(text), "x"))
        labels.append((i, 1, int(toxic)))
    return docs, labels


def frames(spark, docs, labels):
    return spark.createDataFrame(docs, "doc_id long, text string, score string"), spark.createDataFrame(labels, LABELS)


def test_held_out_accuracy(spark):
    docs, labels = corpus()
    labels += [(5000, 0, 1), (None, 0, 1), (3, 0, None), (1, 0, 7)]
    docs += [(None, "scoundrel", "x"), (600, None, "x"), (601, "", "x"), (602, "word " * 20_000, "x"), docs[0], docs[0]]
    given = frames(spark, docs, labels)
    scored = toxicity.with_scores(*given).withColumn("held_out", toxicity.held_out()).collect()
    assert len(scored) == len(docs) and scored[0].__fields__ == ["doc_id", "text", "score", "predicted", "held_out"]
    truth = {i: t for i, _, t in labels if i is not None and i < 400 and t in (0, 1)}
    held = [r for r in scored if r["held_out"] and r["doc_id"] in truth]
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1) for r in scored if r["doc_id"] is not None)
    assert len(held) > 80 and sum(r["predicted"] == truth[r["doc_id"]] for r in held) > 0.95 * len(held)
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.7) for r in scored)
    assert len({r["score"] for r in scored if r["doc_id"] == 0}) == 1
    again = toxicity.with_scores(*given).collect()
    assert sorted((r["doc_id"], r["score"]) for r in again if r["doc_id"] is not None) == sorted((r["doc_id"], r["score"]) for r in scored if r["doc_id"] is not None)


def test_learns_from_no_held_out_row(spark):
    docs, labels = corpus(200)
    given = toxicity.training_rows(*frames(spark, docs, labels)).collect()
    allowed = {t for i, t, _ in docs if zlib.crc32(str(i).encode()) % 3 != 1}
    assert {r["text"] for r in given} == allowed
    few = toxicity.training_rows(*frames(spark, docs, labels), sample_rows=20).count()
    assert 0 < few < 60


@pytest.mark.parametrize("labels", [[], [(1, 0, 1)], [(2, 0, 0), (3, 0, 0)]])
def test_too_little_to_learn_from(spark, labels):
    docs = [(i, f"text {i}", "x") for i in range(6)]
    scores = {r["score"] for r in toxicity.with_scores(*frames(spark, docs, labels)).collect()}
    assert len(scores) == 1 and 0 < scores.pop() < 1
    docs, known = frames(spark, docs, labels)
    assert toxicity.with_scores(docs.limit(0), known).count() == 0


def test_features():
    features = toxicity.Features(toxicity.Lexicon({"nitwit": 4.0, "scou*": 2.0}))
    names = toxicity.Features.NAMES
    assert features.of(None) == features.of("  ") == [0.0] * len(names)
    got = dict(zip(names, features.of("YOU n1tw1t! Scoundrel, fine day"), strict=True))
    assert got["distinct_hits"] == 2 and got["bared_hits"] == 1 and got["heaviest"] == 4.0
    assert got["second_density"] == pytest.approx(1 / 5) and got["near_second"] == pytest.approx((1 / 2 + 1 / 3) / 2)
    assert got["capital_words"] == pytest.approx(1 / 5) and got["hidden_rate"] == pytest.approx(1 / 5)
    assert dict(zip(names, features.of("scou"), strict=True))["hits"] == 0


def test_rates_of_very_long_tokens():
    features = toxicity.Features(toxicity.Lexicon({}))

    def rates(text):
        got = dict(zip(toxicity.Features.NAMES, features.of(text), strict=True))
        return [got[n] for n in ("capital_rate", "sign_rate", "exclamations")]

    for n in (1023, 1024, 65_536, 70_000):
        assert rates("A" * n) == [1.0, 0.0, 0.0]
        assert rates("!" * n) == [0.0, 1.0, 1.0]
    assert rates("ab " + "A" * 1998 + " " + "A" * 1998 + "??") == pytest.approx([3996 / 4000, 2 / 4000, 0.0])
    assert rates("a" * 70_000 + " B!") == pytest.approx([1 / 70_002, 1 / 70_002, 1 / 70_002])
