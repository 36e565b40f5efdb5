"""Resolving a sequential identifier map into a plain old-to-final map.

Map entries (``seq``, ``old_id``, ``new_id``) take effect one after the other in ``seq`` order. A
row with id g follows the first entry with old_id = g, then the first later entry whose old_id is
the id it has now, and so on. Two steps make this set-based:

1. every entry gets a pointer to the entry it leads to, the first later one for its new id;
2. pointers are doubled until none is left, so a chain of n entries takes about log2(n) joins.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerline.scale import BROADCAST_BYTES, Staged, setting, skew_join, stage

# Entries per group when looking for the next entry; also bounds the group of one hot id.
ROWS_PER_BUCKET = 1 << 20


def normal_id(column: Column, kind: T.DataType) -> Column:
    """Identifier in comparable form: text ids ignore case."""
    return F.lower(column) if isinstance(kind, T.StringType) else column


def stage_entries(id_map: DataFrame, allow_self: bool = False) -> Staged:
    """Checked map entries in comparable form, with ``seq`` as bigint.

    ``seq`` must be present and unique. An entry that maps an id to itself would delete holdings and
    zero balances without replacing them, so it is refused unless ``allow_self``.
    """
    entries = id_map.select(
        F.col("seq").cast("long").alias("seq"),
        *[normal_id(F.col(c), id_map.schema[c].dataType).alias(c) for c in ("old_id", "new_id")],
    )
    staged = stage(
        entries,
        "id-map",
        gather=True,
        no_seq=F.count_if(F.col("seq").isNull()),
        to_self=F.count_if(F.col("old_id") == F.col("new_id")),
    )
    if staged.metrics["no_seq"]:
        raise ValueError("map entries without seq")
    if staged.metrics["to_self"] and not allow_self:
        raise ValueError(f"{staged.metrics['to_self']} map entries map an id to itself")
    if staged.df.groupBy("seq").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").take(1):
        raise ValueError("two map entries share one seq")
    return staged


def _bucketed(entries: Staged, rows_per_bucket: int) -> DataFrame | None:
    """Entries with a ``bucket`` that grows with ``seq`` and holds about ``rows_per_bucket`` of them.

    Spark's range partitioning makes the cuts; what it made is staged, so that both uses see it.
    """
    buckets = -(-entries.rows // rows_per_bucket)
    if buckets <= 1:
        return None
    cut = entries.df.repartitionByRange(buckets, "seq")
    return stage(cut.withColumn("bucket", F.spark_partition_id()), "id-buckets").df


def _next_entries(entries: Staged, rows_per_bucket: int) -> DataFrame:
    """Entries with ``next_seq``: the first later entry for their new id, or null.

    An as-of lookup by one sort per group, without pairing entries of the same id. Groups are
    (id, seq bucket), so an id with most of the entries is spread; what lies in later buckets comes
    from one row per (id, bucket).
    """
    bucketed = _bucketed(entries, rows_per_bucket)
    df = entries.df if bucketed is None else bucketed
    extra = [] if bucketed is None else ["bucket"]
    group = ["id", *extra]
    starts = df.filter("old_id is not null").select(
        F.col("old_id").alias("id"), "seq", F.col("seq").alias("start"), F.lit(None).alias("to"), *extra
    )
    asks = df.filter("new_id is not null").select(
        F.col("new_id").alias("id"),
        "seq",
        F.lit(None).cast("long").alias("start"),
        F.col("new_id").alias("to"),
        *extra,
    )
    points = starts.withColumn("to", F.col("to").cast(df.schema["new_id"].dataType)).unionByName(
        asks
    )
    # Counting seq downwards, later entries come first and a running minimum stays linear.
    later = (
        Window.partitionBy(*group)
        .orderBy(-F.col("seq"))
        .rangeBetween(Window.unboundedPreceding, -1)
    )
    found = points.withColumn("near", F.min("start").over(later)).filter("to is not null")
    if bucketed is None:
        resolved = found.select("seq", F.col("near").alias("next_seq"), F.col("to").alias("final_id"))
    else:
        firsts = points.groupBy(*group).agg(F.min("start").alias("first"))
        after = (
            Window.partitionBy("id")
            .orderBy(F.desc("bucket"))
            .rowsBetween(Window.unboundedPreceding, -1)
        )
        beyond = firsts.select("id", "bucket", F.min("first").over(after).alias("far"))
        resolved = found.join(beyond, group).select(
            "seq", F.coalesce("near", "far").alias("next_seq"), F.col("to").alias("final_id")
        )
    ended = df.filter("new_id is null").select(
        "seq", F.lit(None).cast("long").alias("next_seq"), F.col("new_id").alias("final_id")
    )
    return resolved.unionByName(ended)


def _open(links: Staged) -> Staged:
    """The links of a staged table that lead on."""
    waiting = links.df.filter("next_seq is not null")
    return Staged(waiting, links.metrics["open"], links.bytes, links.metrics)


def _links(df: DataFrame, name: str) -> Staged:
    shape = df.select("seq", "next_seq", "final_id")
    return stage(shape, name, open=F.count_if(F.col("next_seq").isNotNull()))


def _double(links: list[Staged], small: bool) -> Staged:
    """Let every open pointer skip to where the entry it points at points; only open entries move.

    The last of ``links`` holds the open ones; what has arrived lies in it and in those before. All of
    them together are no more than the map, so if that is small they are broadcast, and a round is one
    write.
    """
    waiting = _open(links[-1])
    arrived = [part.df.filter("next_seq is null") for part in links]
    targets = reduce(DataFrame.unionByName, [waiting.df, *arrived]).select(
        F.col("seq").alias("next_seq"),
        F.col("next_seq").alias("__next"),
        F.col("final_id").alias("__final"),
    )
    if small:
        moved = waiting.df.join(F.broadcast(targets), "next_seq")
    else:
        # A target is asked for by few links; those that nothing waits for stay out of the join.
        wanted = stage(waiting.df.select("next_seq").distinct(), "id-wanted", gather=True)
        found = stage(skew_join(targets, wanted, ["next_seq"], "left_semi"), "id-targets")
        moved = skew_join(waiting.df, found, ["next_seq"], "inner")
    return _links(
        moved.select("seq", F.col("__next").alias("next_seq"), F.col("__final").alias("final_id")), "id-chains"
    )


def resolve_entries(entries: Staged, rows_per_bucket: int = ROWS_PER_BUCKET) -> Staged:
    """Staged map ``old_id`` to ``final_id``, one row per old id; the final id may be null.

    Every round stages the entries that were still open, once; those that have arrived are kept as they
    are.
    """
    links = [_links(_next_entries(entries, rows_per_bucket), "id-links")]
    # The pointers of an entry take no more room than the entry and one number.
    spark = entries.df.sparkSession
    small = entries.bytes + 16 * entries.rows <= setting(spark, BROADCAST_BYTES)
    while links[-1].metrics["open"]:
        links.append(_double(links, small))
    nodes = reduce(DataFrame.unionByName, [part.df.filter("next_seq is null") for part in links])
    # The first entry of an old id decides. A hot old id is combined map-side.
    firsts = (
        entries.df.filter("old_id is not null")
        .groupBy("old_id")
        .agg(F.min("seq").alias("seq"))
        .join(nodes, "seq")
    )
    return stage(firsts.select("old_id", "final_id"), "id-final")


def resolve_id_map(
    id_map: DataFrame, *, allow_self: bool = False, rows_per_bucket: int = ROWS_PER_BUCKET
) -> Staged:
    """Final id of every old id of a sequential map; see the module text for the rules."""
    return resolve_entries(stage_entries(id_map, allow_self), rows_per_bucket)
