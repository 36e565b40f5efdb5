"""Positional joins: lines of a source against line-number ranges of the same source."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.scale import Staged, broadcast_if_small, stage

# Lines per bucket. A join group is one bucket of one source, however long the source is.
BUCKET_LINES = 1 << 20

_BUCKET = "__bucket"


def bucket_of(column: str, width: int = BUCKET_LINES) -> Column:
    """Bucket of a line number."""
    return F.expr(f"{column} div {int(width)}")


def bucketed(lines: DataFrame, width: int = BUCKET_LINES) -> DataFrame:
    """Lines with the bucket of their line number."""
    return lines.withColumn(_BUCKET, bucket_of("line_no", width))


def bucketed_ranges(
    ranges: DataFrame, first: str, last: str, name: str, width: int = BUCKET_LINES
) -> Staged:
    """Ranges ``first``..``last`` (both included), one row per bucket they touch, staged."""
    low, high = bucket_of(first, width), bucket_of(last, width)
    spread = ranges.filter(F.col(first) <= F.col(last)).withColumn(
        _BUCKET, F.explode(F.sequence(low, high))
    )
    return stage(spread, name)


def join_ranges(
    lines: DataFrame,
    ranges: Staged,
    first: str,
    last: str,
    how: str = "inner",
    width: int = BUCKET_LINES,
) -> DataFrame:
    """Join lines to the ranges that hold them: an equi-join on source and bucket, plus the bounds.

    Ranges of proven small size are broadcast and lines stay in place. Otherwise both sides are
    shuffled on (source, bucket), which cuts a source with most of the lines into many groups.
    """
    left = bucketed(lines, width)
    right = broadcast_if_small(ranges).withColumnRenamed("src", "__src").withColumnRenamed(
        _BUCKET, "__range_bucket"
    )
    held = (
        (left["src"] == right["__src"])
        & (left[_BUCKET] == right["__range_bucket"])
        & left["line_no"].between(right[first], right[last])
    )
    return left.join(right, held, how).drop(_BUCKET, "__src", "__range_bucket")
