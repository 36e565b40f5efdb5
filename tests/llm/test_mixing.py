"""Targets, shares taken, positions and the mixed rows."""

from collections import Counter

import pytest

from ledgerline.llm import mixing

SCHEMA = "doc_id long, text string, source string, epoch int"


def targets_of(sizes, weights=mixing.WEIGHTS, most=mixing.MAX_REPEATS):
    """Targets round by round, source by source."""
    weight = [weights[i % len(weights)] for i in range(len(sizes))]
    target, left, free = [0.0] * len(sizes), float(sum(sizes)), [i for i, n in enumerate(sizes) if n > 0]
    while free:
        whole = sum(weight[i] for i in free)
        over = [i for i in free if left * weight[i] / whole > most * sizes[i]]
        for i in over or free:
            target[i] = float(most * sizes[i]) if over else left * weight[i] / whole
        left -= sum(target[i] for i in over)
        free = [i for i in free if i not in over] if over else []
    return target


def spark_targets(spark, sizes):
    names = [f"s{i:06d}" for i in range(len(sizes))]
    groups = spark.createDataFrame([(n, s, 1) for n, s in zip(names, sizes, strict=True)], "__source string, __size long, __n long")
    rows = mixing.source_targets(groups, mixing.Mixture()).df.collect()
    got = {r["__source"]: r["target"] for r in rows}
    return [got[n] for n in names]


@pytest.mark.parametrize("sizes", [[100, 100, 100], [10, 100, 100], [10, 10, 1000], [], [0, 0], [5, 0, 7, 1, 1], [1, 2, 4, 8, 16, 32, 64, 5000]])
def test_targets_by_weight_with_excess_reshared(spark, sizes):
    got = spark_targets(spark, sizes)
    assert got == pytest.approx(targets_of(sizes)) and sum(got) == pytest.approx(sum(sizes))


def test_a_hundred_thousand_sources(spark):
    sizes = [(i * 7919) % 1000 for i in range(100_000)]
    groups = spark.range(100_000).selectExpr("format_string('s%06d', id) as __source", "id * 7919 % 1000 as __size", "1L as __n")
    rows = mixing.source_targets(groups, mixing.Mixture()).df.orderBy("__source").collect()
    assert [r["target"] for r in rows] == pytest.approx(targets_of(sizes))


def test_many_equal_rows_and_columns_of_all_kinds(spark, monkeypatch):
    monkeypatch.setattr(mixing, "COPIES", 1000)
    base = spark.range(30_000).selectExpr(
        "if(id % 3 > 0, 5, id) as doc_id", "if(id % 3 > 0, 'a b c', concat('w', id)) as text", "if(id % 3 > 0, 'x', 'y') as source",
        "1 as position", "2 as words", "3 as epoch", "4 as __from", "map('k', 1) as m",
    )
    got = mixing.plan(base.select("doc_id", "text", "source")).groupBy("__id").agg({"*": "count", "__from": "max"})
    hot = got.filter("__id = 5").first()
    assert hot["count(1)"] == 20_000 and hot["max(__from)"] >= 3 * 19_999
    mixed = mixing.mix(base)
    assert sorted(mixed.columns) == sorted(base.columns)
    taken = mixing.plan(base).agg({"taken": "sum"}).first()[0]
    assert mixed.agg({"words": "sum"}).first()[0] == taken == 70_000
    kept = mixing.mix_rows(base).select("own.*")
    assert kept.columns == base.columns and {tuple(r) for r in kept.select("position", "words", "epoch").distinct().collect()} == {(1, 2, 3)}


def test_taken_per_document(spark):
    """Every document's words by walking each source in hash order."""
    from pyspark.sql import functions as F

    _, docs = corpus(spark)
    docs = docs.select("doc_id", "source", "text")
    groups = mixing._groups(docs, "source", "doc_id").df
    order = F.xxhash64(F.lit(mixing.SEED), "__source", "__id", "__print").alias("o")
    rows = groups.select("*", order).collect()
    want = Counter()
    sources = sorted({r["__source"] for r in rows}, key=lambda s: (s is None, s or ""))
    sizes = [sum(r["__size"] * r["__n"] for r in rows if r["__source"] == s) for s in sources]
    for s, size, target in zip(sources, sizes, targets_of(sizes), strict=True):
        left = round(target) - round(target) // max(size, 1) * size
        for r in sorted((r for r in rows if r["__source"] == s), key=lambda r: (r["o"], r["__id"], r["__size"])):
            for _ in range(r["__n"]):
                more = min(left, r["__size"])
                want[s, r["__id"], r["__size"], round(target) // max(size, 1) * r["__size"] + more] += 1
                left -= more
    got = Counter((r["__source"], r["__id"], r["__size"], r["taken"]) for r in mixing.plan(docs).collect())
    assert got == want


def corpus(spark):
    rows = [(i, "w " * (i % 40), ["b", "a", "ä", None][i % 4], 1) for i in range(300)]
    rows += [(5, "one two", "a", 1)] * 30 + [(None, "x y z", None, 2), (9, None, "a", 3), (10, "", "b", 3), (11, "v " * 3000, "ä", 1)]
    return rows, spark.createDataFrame(rows, SCHEMA)


def test_plan_takes_the_target(spark):
    rows, docs = corpus(spark)
    got = mixing.plan(docs.select("doc_id", "source", "text")).collect()
    assert len(got) == len(rows)
    sizes = Counter()
    for _, text, source, _ in rows:
        sizes[source] += len((text or "").split())
    want = dict(zip(["a", "b", "ä", None], targets_of([sizes[s] for s in ("a", "b", "ä", None)]), strict=True))
    for source, target in want.items():
        mine = [r for r in got if r["__source"] == source]
        assert {r["source_size"] for r in mine} == {sizes[source]}
        assert sum(r["taken"] for r in mine) == round(target)
        assert [r["target"] for r in mine] == pytest.approx([target] * len(mine))
    assert all(0 <= r["taken"] <= 3 * r["__size"] for r in got)
    again = mixing.plan(docs.select("doc_id", "source", "text").repartition(5)).collect()
    assert Counter(map(repr, again)) == Counter(map(repr, got))


def test_running_sums_over_many_buckets(spark, monkeypatch):
    _, docs = corpus(spark)
    whole = mixing.plan(docs.drop("epoch")).select("__id", "__source", "__size", "taken", "__from").collect()
    monkeypatch.setattr(mixing, "BUCKET_ROWS", 3)
    cut = mixing.plan(docs.drop("epoch")).select("__id", "__source", "__size", "taken", "__from").collect()
    assert Counter(map(repr, cut)) == Counter(map(repr, whole))


def test_mix_rows(spark):
    _, docs = corpus(spark)
    docs = docs.drop("epoch")
    mixed = mixing.mix(docs).collect()
    taken = Counter()
    for r in mixing.plan(docs).collect():
        taken[r["__source"], r["__id"]] += r["taken"]
    words = Counter()
    for r in mixed:
        words[r["source"], r["doc_id"]] += len((r["text"] or "").split())
        assert len((r["text"] or "").split()) == r["words"]
    assert +words == +taken
    positions = [r["position"] for r in mixed]
    assert positions == sorted(positions) and 0 <= positions[0] and positions[-1] <= 1


def test_cut_documents_keep_their_spaces(spark):
    text = "  one two\n\n\tthree   four\r\nfive six \n"
    docs = spark.createDataFrame([(i, text, s) for i in range(5) for s in "abc"], "doc_id long, text string, source string")
    mixed = mixing.mix(docs).collect()
    cut = [r for r in mixed if r["words"] < 6]
    assert cut and all(text.startswith(r["text"]) and len(r["text"].split()) == r["words"] for r in cut)
    assert any("\n" in r["text"] for r in cut)
    assert all(r["text"] == text for r in mixed if r["words"] == 6)
    long = spark.createDataFrame([("a\n b  " * 50_000, 99_999)], "text string, n long")
    got = long.select(mixing._first_words(long["text"], long["n"]).alias("t")).first()["t"]
    assert got == ("a\n b  " * 50_000)[: 49_999 * 6 + 1]


def test_curriculum_inverts_demand(spark):
    from pyspark.sql import functions as F

    for slope in (-0.9, -0.5, 0.0, 0.5, 0.9):
        u = spark.range(11).select((F.col("id") / 10).alias("u"))
        share = (1 - F.lit(slope)) * F.col("u") + F.lit(slope) * F.col("u") ** 2
        got = u.select("u", mixing.time_of(share, F.lit(slope)).alias("t")).collect()
        assert [r["t"] for r in got] == pytest.approx([r["u"] for r in got])


def test_empty_tables(spark):
    docs = spark.createDataFrame([], SCHEMA).drop("epoch")
    assert mixing.plan(docs).count() == 0 and mixing.mix(docs).count() == 0
    wordless = spark.createDataFrame([(1, None, "a"), (2, " ", None)], "doc_id long, text string, source string")
    assert [r["taken"] for r in mixing.plan(wordless).collect()] == [0, 0]
    assert mixing.mix(wordless).count() == 0


def odd_corpus(spark):
    """Null and repeated ids, equal rows, and a source whose documents have no words but for a few."""
    return spark.range(3000).selectExpr(
        "if(id % 7 = 0, null, id % 1100) as doc_id",
        "case when id % 3 = 2 and id % 100 > 1 then '' when id % 5 = 0 then null when id % 11 = 0 then '  '"
        " when id % 13 = 0 then 'a b c' else repeat(concat('w', id % 40, ' '), cast(id % 60 as int)) end as text",
        "element_at(array('x', null, 'bare'), cast(id % 3 + 1 as int)) as source",
    )


def test_the_mix_is_the_same_whatever_the_parts(spark, monkeypatch):
    docs = odd_corpus(spark)
    whole = [repr(r) for r in mixing.mix(docs).collect()]
    assert len(whole) > 3000
    monkeypatch.setattr(mixing, "PART_BYTES", 5000)
    small = mixing.mix(docs)
    assert small.rdd.getNumPartitions() > 20 and [repr(r) for r in small.collect()] == whole
    monkeypatch.setattr(mixing, "BROADCAST_BYTES", 0)
    assert [repr(r) for r in mixing.mix(docs).collect()] == whole


def test_texts_move_once_when_places_are_too_many_to_broadcast(spark, monkeypatch):
    docs = spark.range(4000).selectExpr("id as doc_id", "concat('some words ', id) as text", "concat('s', id % 2) as source")
    monkeypatch.setattr(mixing, "BROADCAST_BYTES", 100_000)
    plan = mixing.mix_rows(docs)._jdf.queryExecution().executedPlan()
    nodes, moves = [plan.initialPlan()], []
    while nodes:
        node = nodes.pop()
        if "Exchange" in node.nodeName() and "__own" in node.output().mkString(" "):
            moves.append(node.nodeName())
        nodes += [node.children().apply(i) for i in range(node.children().size())]
    assert moves == ["Exchange"]
