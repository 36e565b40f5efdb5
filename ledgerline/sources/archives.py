"""Lines of files inside ZIP archives.

Archives are listed by Spark and their directories are read in parallel, piece by piece. An archive is
cut into runs of about ``TASK_BYTES`` by the places of its entries, and a run is read by one task in the
order of the file: a huge archive is read by many tasks at once, each opening it once. Entries are
unpacked as streams; what is held is a piece of an entry and a line, which as one value cannot be less.
Archives must be reachable by path from the executors.
"""

from __future__ import annotations

from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.scale import setting, stage
from ledgerline.sources import zipstream
from ledgerline.sources.listing import listing

# The helpers travel with the tasks, so executors need not have this package installed.
cloudpickle.register_pickle_by_value(zipstream)

_RECORDS = (
    "archive string, entry_no bigint, entry string, bytes bigint, packed_bytes bigint, "
    "start bigint, method bigint, flags bigint, crc bigint"
)
LINES = "archive string, entry_no bigint, entry string, line_no bigint, line string"

_ARCHIVES_PER_TASK = 16

# Packed bytes of an archive that one task should read, about.
TASK_BYTES = ("spark.ledgerline.archiveTaskBytes", 128 * 1024 * 1024)


def _records(spark: SparkSession, mask: str, path: str, recursive: bool) -> DataFrame:
    """Directory records of all files in all matching archives."""
    found = listing(spark, mask, path, recursive)
    archives = found.files.filter("bytes > 0").select(F.col("path").alias("archive"))
    # Directories lie at the ends of archives; a task reads a few of them.
    n = found.plain + found.odd
    tasks = max(1, min(n, max(-(-n // _ARCHIVES_PER_TASK), spark.sparkContext.defaultParallelism)))
    return archives.repartition(tasks).mapInArrow(zipstream.entry_rows, _RECORDS)


def zip_entries(
    spark: SparkSession, mask: str, path: str, *, recursive: bool = False
) -> DataFrame:
    """Files in all matching archives: ``archive``, ``entry_no``, ``entry``, ``bytes``,
    ``packed_bytes``. Folders are left out."""
    records = _records(spark, mask, path, recursive)
    return records.select("archive", "entry_no", "entry", "bytes", "packed_bytes")


def zip_lines(
    spark: SparkSession, mask: str, path: str, *, recursive: bool = False
) -> DataFrame:
    """Lines of all files in all matching archives: ``archive``, ``entry_no``, ``entry``,
    ``line_no``, ``line``.

    The directory records are staged when called, which gives the number of runs and lets a task go
    straight to its entries. Line ends are LF, CR and CRLF; text is UTF-8, or UTF-16 with a byte order
    mark.
    """
    return entry_runs(spark, mask, path, recursive).mapInArrow(zipstream.line_rows, LINES)


def entry_runs(spark: SparkSession, mask: str, path: str, recursive: bool = False) -> DataFrame:
    """Directory records dealt to tasks: a partition holds runs, each one stretch of one archive."""
    place = (F.col("start") / setting(spark, TASK_BYTES)).cast("long").alias("run")
    entries = stage(_records(spark, mask, path, recursive).select("*", place), "zip-entries", gather=True, packed=F.sum("packed_bytes"))
    runs = entries.df.select("archive", "run").distinct().count()
    # A fixed number of partitions: the rows moved here are tiny, so they must not be coalesced. Small
    # archives share tasks, as many as their bytes ask for, or as can work at once.
    asked = -(-(entries.metrics["packed"] or 0) // setting(spark, TASK_BYTES))
    tasks = max(1, min(runs, max(2 * asked, spark.sparkContext.defaultParallelism)))
    return entries.df.repartition(tasks, "archive", "run").sortWithinPartitions("archive", "start")
