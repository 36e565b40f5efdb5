"""Regular-expression search over lines."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.functions.text import containing_path, first_match, ignore_case, native_path


def search_lines(lines: DataFrame, pattern: str, groups: int = 0) -> DataFrame:
    """Lines that hold a match, case ignored: ``src``, ``matches``, ``line_number``.

    ``matches`` has the first match of the line. The filter sits on the raw line, so for numbered
    lines it runs before the numbers are joined.
    """
    found = lines.filter(F.col("line").rlike(ignore_case(pattern)))
    return found.select(
        "src",
        first_match(F.col("line"), pattern, groups).alias("matches"),
        F.col("line_no").alias("line_number"),
    )


def search_archive_lines(
    lines: DataFrame, pattern: str, separator: str = "\\", groups: int = 0
) -> DataFrame:
    """Matches in archive lines: ``filename``, ``path``, ``matches``, ``line_number``."""
    found = lines.filter(F.col("line").rlike(ignore_case(pattern)))
    entry = F.col("entry")
    return found.select(
        native_path(entry, separator).alias("filename"),
        containing_path(F.col("archive"), entry, separator).alias("path"),
        first_match(F.col("line"), pattern, groups).alias("matches"),
        F.col("line_no").alias("line_number"),
    )


def flat_matches(found: DataFrame) -> DataFrame:
    """One row per match, its parts as plain columns."""
    kept = [c for c in found.columns if c != "matches"]
    # Never empty, and the outer form keeps Spark from testing that by matching again.
    each = found.select(*kept, F.explode_outer("matches").alias("m"))
    return each.select(
        *kept,
        F.col("m.value").alias("match_value"),
        F.col("m.index").alias("match_index"),
        F.col("m.length").alias("match_length"),
    )
