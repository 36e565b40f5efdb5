"""Building blocks that keep plans safe on large, skewed data.

* ``stage``      writes a (small, derived) table to the cluster's shared folder and reads it back.
                 It cuts lineage, survives lost executors, and tells the exact rows and bytes, so
                 later join choices rest on a measured size and not on a guess.
* ``broadcast_if_small``  broadcasts a staged table only when its measured size is under a limit.
* ``skew_join``  joins a large side to a staged side: broadcast when that is provably small, else a
                 shuffle join in which every hot key of the large side is spread over many tasks.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from typing import Any

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Settings a user may put on the session; the values here apply when they are unset.
BROADCAST_BYTES = ("spark.ledgerline.broadcastBytes", 256 * 1024 * 1024)
HOT_KEYS = ("spark.ledgerline.hotKeys", 1_000_000)
HOT_ROWS = ("spark.ledgerline.hotKeyRows", 1_000_000)

_WIDE = (T.StringType, T.BinaryType, T.ArrayType, T.MapType, T.StructType)
_SALT = "__salt"
_SALTS = "__salts"


def setting(spark: SparkSession, option: tuple[str, Any]) -> Any:
    """Value of a library setting on this session, in the type of its default."""
    name, default = option
    value = spark.conf.get(name, None)
    return default if value is None else type(default)(value)


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach: the session's ``spark.checkpoint.dir``.

    Without that setting the checkpoint folder of the context is taken, and a local-mode context
    that has none either gets one of its own.
    """
    context = spark.sparkContext
    configured = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if configured:
        return configured.rstrip("/")
    if not context.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    context.setCheckpointDir(tempfile.mkdtemp(prefix="ledgerline-"))
    return context.getCheckpointDir()


def new_shared_path(spark: SparkSession, name: str) -> str:
    """A path under the shared folder that nothing has used before."""
    app = spark.sparkContext.applicationId
    return f"{shared_dir(spark)}/ledgerline/{app}/{name}-{uuid.uuid4().hex}"


@dataclass(frozen=True)
class Staged:
    """A table written to the shared folder, with what was measured while writing it."""

    df: DataFrame
    rows: int
    bytes: int
    metrics: Mapping[str, Any] = field(default_factory=dict)

    def narrowed(self, *columns: str) -> Staged:
        """Some fixed-width columns of the table, with the size they alone have."""
        df = self.df.select(*columns)
        return Staged(df, self.rows, self.rows * fixed_row_bytes(df), self.metrics)


def fixed_row_bytes(df: DataFrame) -> int:
    """Upper estimate of the memory one row of fixed-width columns needs in a hash table."""
    if any(isinstance(f.dataType, _WIDE) for f in df.schema.fields):
        raise TypeError("a column has no fixed width")
    return 48 + 16 * len(df.columns)


def row_bytes(df: DataFrame) -> Column:
    """Upper estimate of the memory one row of plain columns needs in a hash table."""
    total = F.lit(48).cast("long")
    for f in df.schema.fields:
        if isinstance(f.dataType, (T.StringType, T.BinaryType)):
            total = total + F.coalesce(F.octet_length(F.col(f.name)), F.lit(0)) + 24
        elif isinstance(f.dataType, (T.ArrayType, T.MapType, T.StructType)):
            raise TypeError(f"only tables of plain columns are staged, not {f.name}")
        else:
            total = total + 16
    return total


def stage(df: DataFrame, name: str, gather: bool = False, **metrics: Column) -> Staged:
    """Write ``df`` to the shared folder and read it back; runs one Spark job.

    Rows, bytes and any extra aggregate ``metrics`` are observed during that same write. ``gather``
    is for little data that comes straight from a big scan: it is first rebalanced into files of
    normal size, else every scan task would write a tiny one.
    """
    spark = df.sparkSession
    if gather:
        df = df.hint("rebalance")
    path = new_shared_path(spark, name)
    seen = Observation()
    extra = [column.alias(key) for key, column in metrics.items()]
    watched = df.observe(
        seen, F.count(F.lit(1)).alias("__rows"), F.sum(row_bytes(df)).alias("__bytes"), *extra
    )
    watched.write.parquet(path)
    got = dict(seen.get)
    rows, size = int(got.pop("__rows") or 0), int(got.pop("__bytes") or 0)
    return Staged(spark.read.schema(df.schema).parquet(path), rows, size, got)


def is_small(staged: Staged) -> bool:
    """Whether a staged table may be broadcast, by its measured size."""
    return staged.bytes <= setting(staged.df.sparkSession, BROADCAST_BYTES)


def broadcast_if_small(staged: Staged) -> DataFrame:
    """The staged table, with a broadcast hint only if its measured size allows it."""
    return F.broadcast(staged.df) if is_small(staged) else staged.df


def part_of(whole: Staged, part: DataFrame, name: str) -> Staged:
    """A table with no more rows than ``whole`` and columns of it only, staged if that is not small.

    What is derived from a small table is small as well, so its size need not be measured again.
    """
    return Staged(part, whole.rows, whole.bytes) if is_small(whole) else stage(part, name)


def hot_keys(df: DataFrame, keys: Sequence[str]) -> Staged:
    """Keys with many rows in ``df``, NULL included, and over how many groups to deal their rows.

    A key is hot from ``HOT_ROWS`` rows on, which is also the size of a group. The heaviest ``HOT_KEYS``
    of them are split, whatever the number of rows; only if more keys than that are hot do the
    lightest of them stay whole. The count is combined map-side, so a hot key never travels as rows.
    """
    spark = df.sparkSession
    group = setting(spark, HOT_ROWS)
    n = F.col("__n")
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("__n"))
    heavy = stage(counts.filter(n >= group), "key-counts")
    most = setting(spark, HOT_KEYS)
    chosen = heavy.df if heavy.rows <= most else heavy.df.orderBy(F.desc("__n")).limit(most)
    salts = F.ceil(n / group).cast("int").alias(_SALTS)
    return stage(chosen.select(*keys, salts), "hot-keys")


def skew_join(left: DataFrame, right: Staged, keys: Sequence[str], how: str = "left") -> DataFrame:
    """Join ``left`` to a staged ``right`` on equally named ``keys``; hot keys never share a task.

    ``how`` is any join type that keeps or drops left rows (inner, left, left_semi, left_anti).
    A right side of proven small size is broadcast and the left side does not move. Otherwise the
    rows of each hot left key (NULL included) are dealt over groups by the id of the task that holds
    them, which stays the same when a task is retried, and only the right rows of those keys are
    repeated, once per group.
    """
    keys = list(keys)
    if is_small(right):
        return left.join(F.broadcast(right.df), keys, how)
    found = hot_keys(left, keys)
    if not found.rows:
        return left.join(right.df, keys, how)
    hot = broadcast_if_small(found)
    groups = F.coalesce(F.col(_SALTS), F.lit(1))

    def marked(side: DataFrame) -> DataFrame:
        same = [side[k].eqNullSafe(hot[k]) for k in keys]
        return side.join(hot, same, "left").drop(*[hot[k] for k in keys])

    salted = marked(left).withColumn(_SALT, F.spark_partition_id() % groups)
    repeated = marked(right.df).withColumn(_SALT, F.explode(F.sequence(F.lit(0), groups - 1)))
    return (
        salted.drop(_SALTS).join(repeated.drop(_SALTS), [*keys, _SALT], how).drop(_SALT)
    )
