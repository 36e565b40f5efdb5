"""Writing lines as text folders, one per source, and reading them back in order.

Below the folder of a source there is one folder per block of its lines, ``block=<number>``, the
number padded with zeros, and in it one part file. All part files of a source in order of their paths
hold its lines in order. Blocks bound the work of a task, so a source with most of the lines is
written by many tasks.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.operators.ranges import BUCKET_LINES, bucket_of
from ledgerline.sources.lines import number_scanned, of_session, split_session

_DIGITS = 18


def _padded(number: Column) -> Column:
    return F.lpad(number.cast("string"), _DIGITS, "0")


def _named(by: Sequence[str]) -> list[Column]:
    """The folder columns; a null or empty name is an error, as both would become one folder."""
    nameless = F.raise_error(F.lit("a source without a name cannot be written"))
    return [F.when(F.length(c) > 0, F.col(c)).otherwise(nameless).alias(c) for c in by]


def write_lines(
    lines: DataFrame, out: str, by: Sequence[str] = ("src",), width: int = BUCKET_LINES
) -> None:
    """Write numbered lines to ``out/src=.../block=.../``, with a folder level per ``by`` column.

    One shuffle on folder and block, each block ``width`` line numbers long; the lines are computed
    once, which a range partitioning with its sampling pass would not do. Folder names are escaped
    by Spark. The input folder is never written to.
    """
    folders = [*by, "block"]
    (
        lines.select(*_named(by), _padded(bucket_of("line_no", width)).alias("block"), "line_no", "line")
        .repartition(*folders)
        .sortWithinPartitions(*folders, "line_no")
        .select(*folders, "line")
        .write.partitionBy(*folders)
        .text(out)
    )


def write_scanned_lines(
    lines: DataFrame, out: str, by: Sequence[str] = ("src",), order: str = "pos", mode: str = "error"
) -> None:
    """Write lines straight from the tasks that read them, without a shuffle.

    Takes the ``by`` columns, ``block``, ``line`` and the ``order`` of lines within a block. Each
    input split becomes one part file in ``out/src=.../block=.../`` per folder it has lines for, the
    block being its first byte.
    """
    folders = [*by, "block"]
    (
        lines.select(*_named(by), _padded(F.col("block")).alias("block"), order, "line")
        .sortWithinPartitions(*folders, order)
        .select(*folders, "line")
        .write.mode(mode)
        .partitionBy(*folders)
        .text(out)
    )


def read_written_lines(
    spark: SparkSession, out: str, by: Sequence[str] = ("src",)
) -> DataFrame:
    """Read a folder of ``write_lines`` or ``write_scanned_lines``.

    Gives the ``by`` columns, ``line_no`` counted anew from 1 within them, and ``line``. Like all
    numbering it counts the lines per file split in a pass of its own.
    """
    columns = ["value string", *[f"{c} string" for c in by], "block bigint"]
    text = split_session(spark).read.schema(", ".join(columns)).text(out)
    meta = F.col("_metadata")
    scanned = text.select(
        *by,
        "block",
        meta["file_path"].alias("f"),
        meta["file_block_start"].alias("split_start"),
        meta["file_block_length"].alias("size"),
        F.monotonically_increasing_id().alias("pos"),
        F.col("value").alias("line"),
    )
    names = {c: F.col(c) for c in by}
    return number_scanned(of_session(spark, scanned), names, by, ["block", "f", "split_start"]).lines
