"""Masking of text files as they arrive."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

from ledgerline.operators.masking import Layout, mask_by_layout
from ledgerline.sinks.text import write_scanned_lines
from ledgerline.sources.lines import source_name


def stream_lines(spark: SparkSession, folder: str, names: str = "path") -> DataFrame:
    """Lines of the files that appear in a folder: ``src``, ``block``, ``line``.

    Sources are named as by ``read_lines``, and ``block`` is the first byte of the split. A file arrives
    whole in one micro-batch.
    """
    text = spark.readStream.format("text").load(folder)
    meta = F.col("_metadata")
    scanned = text.select(
        meta["file_path"].alias("f"),
        meta["file_block_start"].alias("block"),
        F.col("value").alias("line"),
    )
    source = source_name(spark, names, folder, F.col("f"))
    return scanned.select(source.alias("src"), "block", "line")


def mask_stream(
    lines: DataFrame, layouts: Sequence[Layout], out: str, checkpoint: str
) -> DataStreamWriter:
    """Writer of masked lines to ``out/batch=.../src=.../block=.../``; the caller adds a trigger and
    starts it.

    Every micro-batch is written like a batch job, by the tasks that read it, so the part files of a
    source in order of their paths hold its lines in order. A batch that is run again replaces its own
    folder. Masking looks at each line alone, so there is no state, watermark or shuffle.
    """

    def write(batch: DataFrame, number: int) -> None:
        placed = batch.withColumn("pos", F.monotonically_increasing_id())
        masked = mask_by_layout(placed, layouts)
        write_scanned_lines(masked, f"{out}/batch={number:012d}", mode="overwrite")

    return lines.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
