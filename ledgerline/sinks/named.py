"""Writing lines as plain files with names of their own.

Tasks write blocks of lines to the shared folder, all blocks of a task into one file, and report them; the
report, one row per block, is the manifest. Then one task per file copies the blocks of a file in order, so
only the making of one file is sequential. Files without lines are written empty. Blocks are removed when
all files are there.
"""

from __future__ import annotations

from functools import partial

from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.scale import new_shared_path, stage
from ledgerline.sinks import filewrite
from ledgerline.sources.listing import qualified

cloudpickle.register_pickle_by_value(filewrite)

_BLOCKS = "file string, block bigint, path string, at bigint, bytes bigint"


def prefixed(src: Column, prefix: str) -> Column:
    """The path of a source with something put before the name of the file."""
    return F.concat(F.regexp_extract(src, r"(?s)^(.*/)", 1), F.lit(prefix), F.substring_index(src, "/", -1))


def _checked(file: Column) -> Column:
    """The name of a file below the output folder; one that would leave it is an error."""
    outside = file.isNull() | file.rlike(r"(?s)^$|^/|/$|(^|/)[.]{1,2}(/|$)|//")
    return F.when(~outside, file).otherwise(F.raise_error(F.concat(F.lit("no name for a file: "), F.coalesce(file, F.lit("null")))))


def _tasks(spark: SparkSession, files: int, size: int | None) -> int:
    """Tasks for so many files of so many bytes in all: a file is about as much work as 256 KB."""
    asked = -(-((size or 0) + files * (256 << 10)) // (128 << 20))
    return max(1, min(files, max(asked, spark.sparkContext.defaultParallelism)))


def write_files(lines: DataFrame, files: DataFrame, out: str, order: str = "pos", scanned: bool = True) -> DataFrame:
    """Write ``lines`` (``file``, ``block``, ``line`` and the ``order`` of lines in a block) as the ``files``
    (``file``, and ``cut``: without the line end after the last line) below ``out``; gives ``file`` and ``bytes``.

    Blocks are in order of their numbers. The lines of a block must lie in one task: those of ``scanned``
    lines do, others are brought together. Every file that has lines must be among ``files``.
    """
    spark = lines.sparkSession
    blocks = qualified(spark, new_shared_path(spark, "blocks"))
    rows = lines.select(_checked(F.col("file")).alias("file"), "block", order, "line")
    rows = rows if scanned else rows.repartition("file", "block")
    rows = rows.sortWithinPartitions("file", "block", order).select("file", "block", "line")
    manifest = stage(rows.mapInArrow(partial(filewrite.block_rows, folder=blocks), _BLOCKS), "block-manifest", gather=True, total=F.sum("bytes"))
    parts = manifest.df.groupBy("file").agg(
        F.array_sort(F.collect_list(F.struct("block", "path", "at", "bytes"))).alias("blocks")
    )
    wanted = files.select(_checked(F.col("file")).alias("file"), "cut").join(parts, "file", "left")
    n = files.count()
    dealt = wanted.repartition(_tasks(spark, n, manifest.metrics["total"]))
    made = dealt.sortWithinPartitions(F.get("blocks", F.lit(0))["path"]).mapInArrow(
        partial(filewrite.file_rows, folder=qualified(spark, out)), "file string, bytes bigint"
    )
    written = stage(made, "written-files", gather=True)
    if written.rows != n or (written.df.agg(F.count_distinct("file")).first()[0] != n):
        raise ValueError("two files share one name")
    if manifest.rows:
        gone = manifest.df.select("path").distinct()
        stage(gone.mapInArrow(filewrite.removed_rows, "path string"), "removed-blocks", gather=True)
    return written.df
