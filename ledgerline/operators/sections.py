"""Header, data and trailer sections of line sources."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.operators.ranges import BUCKET_LINES, bucketed_ranges, join_ranges

# The names of the sections.
SECTIONS = ("header", "data", "trailer")


def _sizes(header: int, trailer: int) -> tuple[int, int]:
    header, trailer = int(header), abs(int(trailer))
    if header < 0:
        raise ValueError("the header count must not be negative")
    return header, trailer


def line_counts(lines: DataFrame) -> DataFrame:
    """Per source: how many ``lines`` it has."""
    return lines.groupBy("src").agg(F.count(F.lit(1)).alias("lines"))


def section_counts(
    lines: DataFrame, header: int = 0, trailer: int = 0, counts: DataFrame | None = None
) -> DataFrame:
    """Per source: ``lines``, and how many of them are ``header``, ``data`` and ``trailer``.

    A source shorter than header plus trailer counts the shared lines in both. ``counts`` spares
    counting the lines where that is known.
    """
    head, tail = _sizes(header, trailer)
    n = F.col("lines")
    return (line_counts(lines) if counts is None else counts).select(
        "src",
        "lines",
        F.least(n, F.lit(head).cast("long")).alias("header"),
        F.greatest(n - head - tail, F.lit(0).cast("long")).alias("data"),
        F.least(n, F.lit(tail).cast("long")).alias("trailer"),
    )


def split_sections(
    lines: DataFrame,
    header: int = 0,
    trailer: int = 0,
    width: int = BUCKET_LINES,
) -> DataFrame:
    """Lines with their ``section``: the first ``header`` lines, the last ``trailer``, the rest.

    A count of 0 gives an empty section. A line in header and trailer at once appears in both.
    Lines that carry the length of their source as ``src_lines`` need nothing else. For others the
    lengths are counted and joined as line ranges, as only the last lines need them. A ``block``
    column is kept.
    """
    head, tail = _sizes(header, trailer)
    in_head = F.col("line_no") <= head
    if not tail:
        in_tail = F.lit(False)
    elif "src_lines" in lines.columns:
        in_tail = F.col("line_no") > F.col("src_lines") - tail
    else:
        last = F.col("lines")
        ends = line_counts(lines).select(
            "src",
            F.greatest(last - tail + 1, F.lit(1)).alias("__first"),
            last.alias("__last"),
        )
        ranges = bucketed_ranges(ends, "__first", "__last", "section-ends", width)
        lines = join_ranges(lines, ranges, "__first", "__last", "left", width)
        in_tail = F.col("__last").isNotNull()
    sections = F.array_compact(
        F.array(
            F.when(in_head, F.lit("header")),
            F.when(~in_head & ~in_tail, F.lit("data")),
            F.when(in_tail, F.lit("trailer")),
        )
    )
    kept = [c for c in ("src", "line_no", "line", "block") if c in lines.columns]
    return lines.select(*kept, F.explode(sections).alias("section"))
