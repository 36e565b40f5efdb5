"""Mixing sources to target weights with a time-varying curriculum, on DataFrame functions.

A source's weight is a function of training time u in [0, 1]; here it rises or falls linearly around
its mean. Its integral is the source's cumulative token demand D(u) = T * ((1 - a) * u + a * u^2),
T being the words the source gives in all and a its slope. The documents of a source, in seeded hash
order and repeated as often as needed, form a stream of words; word c of it is due when D(u) = c, so
the inverse of D turns each document's place in the stream into its training position, and the mix is
the documents range-sorted by position.

Targets: every source asks for its weight's share of all words, none gets more than ``MAX_REPEATS``
times its size, and the excess goes to the others by weight until no target is above. The document in
which a source's demand ends is taken in part, so a source gives its target to the word.

Running sums never pass through one task: hash order is cut into buckets of about ``BUCKET_ROWS``
rows, sums over the buckets (a few rows) give each its start, and a window runs inside a bucket.
Repeated rows are counted first and take consecutive places; many equal rows are told apart in parts of
``COPIES``. Sources and their targets are a staged table, and each round of resharing is one aggregate
over it. Texts do not take part in any of this, and move once, straight to the range of places that a task
writes: in a source and epoch, places follow hash order but for documents without words, so a few hashes per
range tell a text where it may be due. There it meets its places, which were sent to the same range.

Defined cases: a null text has no words; a null source is a source of its own and comes last; a null
id is one more id; a document without words takes none and has the position of its place; equal
positions are ordered by id and hash; an empty table gives an empty result. Other columns of any type
travel with their rows; ``epoch``, ``words`` and ``position`` of ``mix`` take the place of columns of
that name, which ``mix_rows`` keeps.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgerline.llm.common import BROADCAST_BYTES, WORD, Staged, documents, placed, row_hash, stage

WEIGHTS = (5, 2, 1)
#: Slope of the weight over training time, repeating like the weights: at the start a source has
#: (1 - a) times its mean weight, at the end (1 + a) times.
SLOPES = (-0.5, 0.0, 0.5)
MAX_REPEATS = 3
SEED = 8
BUCKET_ROWS = 50_000
COPIES = 10_000
#: Bytes of text, about, that one task writes in the order of the mix.
PART_BYTES = 64 * 1024 * 1024


@dataclass(frozen=True)
class Mixture:
    """What a source is asked for: weights and slopes repeat over the sources in their order."""

    weights: tuple[float, ...] = WEIGHTS
    slopes: tuple[float, ...] = SLOPES
    max_repeats: int = MAX_REPEATS


def word_count(text: str = "text") -> Column:
    """Words of a text, counted as ends of runs that are no space."""
    spaced = F.regexp_count(F.col(text), F.lit(WORD))
    return F.coalesce(spaced, F.lit(0)).cast("long")


_KEYS = ["__source", "__id", "__size", "__print"]


def _narrow(docs: DataFrame, source: str, key: str) -> DataFrame:
    """Source, id, size and a hash of the whole row: what decides a document's place; and its bytes."""
    return docs.select(
        F.col(f"`{source}`").cast("string").alias("__source"), F.col(f"`{key}`").alias("__id"), word_count().alias("__size"),
        row_hash(docs).alias("__print"), F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("__bytes"),
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("__own"),
    )


def _cycled(values: tuple[float, ...]) -> Column:
    return F.element_at(F.array(*[F.lit(float(v)) for v in values]), (F.col("__at") % len(values) + 1).cast("int"))


def source_targets(groups: DataFrame, mixture: Mixture) -> Staged:
    """__source, source_size, target, slope and bits per source, in code point order, null last.

    A source whose share of what is left is above its bound gets the bound, and the others share the rest
    by weight. The share of a unit of weight only grows from round to round, so who is above in a round
    stays so, and a round needs two sums over the sources.
    """
    sums = groups.groupBy("__source").agg(
        F.sum(F.col("__size") * F.col("__n")).alias("source_size"), F.sum("__n").alias("rows")
    )
    numbered, _ = placed(sums, [F.asc_nulls_last("__source")], "mix-sources", "__at")
    size = F.col("source_size").cast("double")
    weight, bound = F.col("weight"), size * mixture.max_repeats
    table = numbered.select(
        "__source", "source_size", "rows", _cycled(mixture.weights).alias("weight"), _cycled(mixture.slopes).alias("slope")
    )
    table = stage(table, "mix-weights", total=F.sum("source_size"))
    left = total = float(table.metrics["total"] or 0)
    above, full = F.lit(False), 0
    free = table.df.filter("source_size > 0").agg(F.sum("weight")).first()[0]
    whole = float(free or 0.0)
    while whole:
        above = F.lit(left) * weight / F.lit(whole) > bound
        held = table.df.filter("source_size > 0").agg(
            F.count_if(above).alias("n"),
            F.coalesce(F.sum(F.when(above, bound)), F.lit(0.0)).alias("words"),
            F.coalesce(F.sum(F.when(~above, weight)), F.lit(0.0)).alias("weight"),
        ).first()
        if held["n"] == full or not held["weight"]:
            break
        full, left, whole = held["n"], total - held["words"], float(held["weight"])
    share = F.when(above, bound).otherwise(F.lit(left) * weight / F.lit(whole or 1.0))
    buckets = F.floor(F.col("rows") / BUCKET_ROWS).cast("long")
    bits = F.when(buckets > 0, F.length(F.bin(buckets))).otherwise(0)
    target = F.when(F.col("source_size") > 0, share).otherwise(0.0)
    return stage(
        table.df.select("__source", "source_size", target.alias("target"), "slope", bits.alias("bits")), "mix-targets"
    )


def _order(seed: int) -> Column:
    return F.xxhash64(F.lit(seed), "__source", "__id", "__print")


def places(groups: DataFrame, targets: Staged, seed: int) -> DataFrame:
    """Every group of equal rows with __from, the words of its source before it in hash order."""
    asked = targets.df.withColumnRenamed("__source", "__asked")
    asked = F.broadcast(asked) if targets.bytes <= BROADCAST_BYTES else asked.hint("merge")
    known = groups.join(asked, groups["__source"].eqNullSafe(asked["__asked"])).drop("__asked")
    placed = known.withColumn("__order", _order(seed)).withColumn(
        "__bucket", F.expr("shiftright(shiftright(__order, 1) + shiftleft(1L, 62), 63 - bits)")
    )
    words = F.col("__size") * F.col("__n")
    sums = placed.groupBy("__source", "__bucket").agg(F.sum(words).alias("w"))
    earlier = Window.partitionBy("__source").orderBy("__bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = sums.select(
        F.col("__source").alias("s"), F.col("__bucket").alias("b"), F.coalesce(F.sum("w").over(earlier), F.lit(0)).alias("__start")
    )
    starts = stage(starts, "mix-starts", gather=True)
    small = F.broadcast(starts.df) if starts.bytes <= BROADCAST_BYTES else starts.df
    joined = placed.join(small, F.col("__source").eqNullSafe(F.col("s")) & (F.col("__bucket") == F.col("b"))).drop("s", "b")
    inside = Window.partitionBy("__source", "__bucket").orderBy("__order", "__id", "__size").rowsBetween(Window.unboundedPreceding, -1)
    return joined.withColumn("__from", F.col("__start") + F.coalesce(F.sum(words).over(inside), F.lit(0)))


def time_of(share: Column, slope: Column) -> Column:
    """Training time at which a source has given this share of its words: the inverse of
    (1 - a) * u + a * u^2, written so that no digits cancel."""
    b = 1 - slope
    return 2 * share / (b + F.sqrt(F.greatest(b * b + 4 * slope * share, F.lit(0.0))))


def _groups(docs: DataFrame, source: str, key: str) -> Staged:
    """Documents that are equal in all, counted."""
    counted = _narrow(docs, source, key).groupBy(*_KEYS, "__bytes").agg(F.count(F.lit(1)).alias("__n"))
    return stage(counted, "mix-groups", most=F.max("__n"), repeated=F.count_if(F.col("__n") > 1))


def _copies(placed_groups: DataFrame, most: int) -> DataFrame:
    """A row per document of every group, with __copy; a large group is dealt to tasks in parts."""
    n = F.col("__n")
    parts = F.sequence(F.lit(0).cast("long"), F.floor((n - 1) / COPIES))
    rows = placed_groups.withColumn("__part", F.explode(parts))
    if most > COPIES:
        rows = rows.repartition(*_KEYS, "__part")
    first = F.col("__part") * COPIES
    return rows.withColumn("__copy", F.explode(F.sequence(first, F.least(n, first + COPIES) - 1))).drop("__part")


def _planned(groups: Staged, mixture: Mixture, seed: int) -> DataFrame:
    placed_groups = places(groups.df, source_targets(groups.df, mixture), seed)
    rows = _copies(placed_groups, groups.metrics["most"] or 0)
    rows = rows.withColumn("__from", F.col("__from") + F.col("__copy") * F.col("__size"))
    whole = F.round("target").cast("long")
    epochs = F.when(F.col("source_size") > 0, F.floor(whole / F.col("source_size"))).otherwise(0)
    rest = F.greatest(whole - epochs * F.col("source_size") - F.col("__from"), F.lit(0))
    return rows.withColumn("epochs", epochs).withColumn("taken", epochs * F.col("__size") + F.least(rest, F.col("__size")))


def plan(docs: DataFrame, source: str = "source", key: str = "doc_id", mixture: Mixture | None = None, seed: int = SEED) -> DataFrame:
    """One row per document row: __source, __id, __size, __print, source_size, target, slope, __from
    (its own place), and taken, the words of it in the mix."""
    return _planned(_groups(docs, source, key), mixture or Mixture(), seed)


def _texts(docs: DataFrame, groups: Staged, source: str, key: str) -> DataFrame:
    """One row per group of equal documents: its keys, and one of the documents as __own."""
    every = _narrow(docs, source, key).select(*_KEYS, "__own")
    if not groups.metrics["repeated"]:
        return every
    # Only documents that have equals are brought together.
    again = stage(groups.df.filter("__n > 1").select(F.col("__print").alias("__again")).distinct(), "mix-repeated")
    known = F.broadcast(again.df) if again.bytes <= BROADCAST_BYTES else again.df.hint("merge")
    single = every.join(known, F.col("__print") == F.col("__again"), "left_anti")
    equal = every.join(known, F.col("__print") == F.col("__again"), "left_semi")
    return single.unionByName(equal.groupBy(*_KEYS).agg(F.first("__own").alias("__own")))


def _sent(texts: DataFrame, spots: DataFrame, parts: int, seed: int) -> DataFrame:
    """The texts, once for each epoch and part that may hold them: every one that does, and at the edges of
    parts some that do not.

    What a part holds of a source in an epoch is told by the first and last hash and id in each bucket of
    hash order. Documents without words have the position of others and are by id there, so they are told
    apart.
    """
    bits = max(1, (parts - 1).bit_length())

    def hashed(rows: DataFrame) -> DataFrame:
        rows = rows.withColumn("__order", _order(seed)).withColumn("__wordless", F.col("__size") == 0)
        return rows.withColumn("__bucket", F.shiftright("__order", 64 - bits))

    key, order = F.col("__id"), F.col("__order")
    cuts = hashed(spots).groupBy(
        F.col("__source").alias("__cut"), F.col("__bucket").alias("__in"), F.col("__wordless").alias("__no_words"), "epoch", "__part"
    ).agg(
        F.min(order).alias("__first"), F.max(order).alias("__last"),
        F.min(key).alias("__low"), F.max(key).alias("__high"), F.bool_or(key.isNull()).alias("__null"),
    )
    cuts = stage(cuts, "mix-cuts", gather=True)
    held = F.broadcast(cuts.df) if cuts.bytes <= BROADCAST_BYTES else cuts.df.hint("merge")
    same = F.col("__source").eqNullSafe(F.col("__cut")) & (F.col("__bucket") == F.col("__in"))
    same &= F.col("__wordless") == F.col("__no_words")
    inside = order.between(F.col("__first"), F.col("__last"))
    inside &= F.when(key.isNull(), F.col("__null")).otherwise(key.between(F.col("__low"), F.col("__high")))
    return hashed(texts).join(held, same & inside).select(*_KEYS, "__own", "epoch", "__part")


def mix_rows(
    docs: DataFrame, source: str = "source", key: str = "doc_id", mixture: Mixture | None = None, seed: int = SEED
) -> DataFrame:
    """The mixed corpus as ``own`` (the document as a struct), ``epoch``, ``words`` and ``position``; see ``mix``."""
    groups = _groups(docs, source, key)
    spots = _planned(groups, mixture or Mixture(), seed)
    total = F.round("target").cast("long")
    reached = F.col("epochs") + F.when(
        F.col("__from") < total - F.col("epochs") * F.col("source_size"), 1
    ).otherwise(0)
    each = spots.withColumn("epoch", F.explode(F.sequence(F.lit(1).cast("long"), reached))).where(reached > 0)
    start = F.col("__from") + (F.col("epoch") - 1) * F.col("source_size")
    share = F.when(total > 0, F.least(start / total, F.lit(1.0))).otherwise(0.0)
    taken = each.select(
        *_KEYS,
        "__bytes",
        "__copy",
        "epoch",
        time_of(share, F.col("slope")).alias("position"),
        F.least(F.col("__size"), total - start).alias("words"),
    )
    order = ["position", "__id", "__print", "epoch", "__copy"]
    taken, staged = placed(taken, [F.col(c) for c in order], "mix-places", "__place")
    size = staged.df.agg(F.sum("__bytes")).first()[0] or 0
    parallel = docs.sparkSession.sparkContext.defaultParallelism
    parts = max(1, -(-size // PART_BYTES), min(parallel, staged.rows))
    part = F.floor(F.col("__place") * parts / max(1, staged.rows)).cast("int")
    spots = taken.withColumn("__part", part)
    sent = _sent(_texts(docs, groups, source, key), spots, parts, seed).repartitionById(parts, F.col("__part"))
    keys = [*_KEYS, "epoch", "__part"]
    spots = spots.select(*[F.col(k).alias(f"{k}2") for k in keys], "position", "words", "__place")
    # Both sides lie by part already, so this join moves nothing.
    spots = spots.repartitionById(parts, F.col("__part2")).hint("merge")
    met = F.col("__part") == F.col("__part2")
    for k in keys[:-1]:
        met &= F.col(k).eqNullSafe(F.col(f"{k}2"))
    joined = sent.join(spots, met)
    text = F.col("__own").getField("text")
    cut = F.when(F.col("words") < F.col("__size"), _first_words(text, F.col("words"))).otherwise(text)
    own = F.struct(*[(cut if c == "text" else F.col("__own").getField(c)).alias(c) for c in docs.columns])
    ranged = joined.select("__own", "__size", "epoch", "words", "position", "__place").sortWithinPartitions("__place")
    return ranged.select(own.alias("own"), "epoch", "words", "position")


def mix(docs: DataFrame, source: str = "source", key: str = "doc_id", mixture: Mixture | None = None, seed: int = SEED) -> DataFrame:
    """The mixed corpus: the documents, once per time they are taken, with ``position`` (0 to 1),
    ``epoch`` and ``words``, in ranges of their places. Where the demand of a source ends inside a
    document, its text is cut after the words that are taken. A document without words comes once
    per epoch that reaches it."""
    new = ["epoch", "words", "position"]
    own = [F.col("own").getField(c).alias(c) for c in docs.columns if c not in new]
    return mix_rows(docs, source, key, mixture, seed).select(*own, *new)


def _first_words(text: Column, n: Column) -> Column:
    """The text up to the end of its n-th word, as it is written."""
    spaced = F.regexp_extract_all(text, F.lit(rf"([\x20\x09-\x0D]*{WORD})"))
    return F.array_join(F.slice(spaced, 1, n.cast("int")), "")


def op8_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    spots = plan(documents(spark, sf_dir).select("doc_id", "source", "text"))
    total = F.round("target").cast("long")
    share = F.when(total > 0, F.least(F.col("__from") / total, F.lit(1.0))).otherwise(0.0)
    rows = spots.select(
        F.col("__id").alias("doc_id"),
        F.col("__source").alias("source"),
        F.col("__size").alias("size"),
        "source_size",
        "target",
        "taken",
        F.when(F.col("taken") > 0, time_of(share, F.col("slope"))).alias("first_position"),
    )
    return rows.repartitionByRange("first_position", "doc_id").sortWithinPartitions("first_position", "doc_id")
