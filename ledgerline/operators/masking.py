"""Masking of lines. Stateless column work: no shuffle, runs on batch and streaming lines alike."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.functions import text as tx

# Fixed value: only delimited rows with this start are masked by default.
DEFAULT_ROW_PREFIX = "D1"


@dataclass(frozen=True)
class Layout:
    """How the sources whose name matches ``src_pattern`` are masked.

    ``kind`` is ``F`` (fixed width, by ``ranges``) or ``D`` (delimited, by ``delimiter`` and
    ``columns``). With a ``row_prefix``, other rows are copied as they are.
    """

    kind: str
    src_pattern: str = ""
    ranges: tuple[tuple[int, int], ...] = tx.DEFAULT_RANGES
    delimiter: str | None = None
    columns: tuple[int, ...] = tx.DEFAULT_FIELDS
    row_prefix: str | None = None

    def __post_init__(self) -> None:
        kind = self.kind.upper()
        if kind not in ("F", "D"):
            raise ValueError(f"unknown file structure: {self.kind!r}")
        if kind == "D" and not self.delimiter:
            raise ValueError("a delimited layout needs a delimiter")
        object.__setattr__(self, "kind", kind)

    def applies(self, line: Column) -> Column:
        return line.startswith(self.row_prefix) if self.row_prefix else F.lit(True)

    def masked(self, line: Column) -> Column:
        if self.kind == "F":
            done = tx.mask_ranges(line, self.ranges)
        else:
            done = tx.mask_fields(line, self.delimiter, self.columns)
        return F.when(self.applies(line), done).otherwise(line) if self.row_prefix else done

    def masked_chars(self, line: Column) -> Column:
        if self.kind == "F":
            chars = tx.ranges_chars(line, self.ranges)
        else:
            chars = tx.fields_chars(line, self.delimiter, self.columns)
        return F.when(self.applies(line), chars).otherwise(F.lit(0))


def fixed(ranges=tx.DEFAULT_RANGES, row_prefix: str | None = None, src_pattern: str = "") -> Layout:
    """Layout of a fixed-width source."""
    return Layout("F", src_pattern, ranges=tuple(map(tuple, ranges)), row_prefix=row_prefix)


def delimited(
    delimiter: str,
    columns=tx.DEFAULT_FIELDS,
    row_prefix: str | None = DEFAULT_ROW_PREFIX,
    src_pattern: str = "",
) -> Layout:
    """Layout of a delimited source."""
    return Layout(
        "D", src_pattern, delimiter=delimiter, columns=tuple(columns), row_prefix=row_prefix
    )


def mask_fixed(
    lines: DataFrame, ranges=tx.DEFAULT_RANGES, row_prefix: str | None = None
) -> DataFrame:
    """Mask character ranges (0-based, both ends included) of every line."""
    return lines.withColumn("line", fixed(ranges, row_prefix).masked(F.col("line")))


def mask_delimited(
    lines: DataFrame,
    delimiter: str,
    columns=tx.DEFAULT_FIELDS,
    row_prefix: str | None = DEFAULT_ROW_PREFIX,
) -> DataFrame:
    """Mask 0-based fields of the lines that start with ``row_prefix``."""
    layout = delimited(delimiter, columns, row_prefix)
    return lines.withColumn("line", layout.masked(F.col("line")))


def _by_layout(layouts: Sequence[Layout], value) -> Column:
    """First layout whose pattern matches the source; a source without one is an error."""
    if not layouts:
        raise ValueError("no layout given")
    missing = F.raise_error(F.concat(F.lit("no mask layout for source "), F.col("src")))
    chosen = None
    for layout in layouts:
        test = F.col("src").rlike(layout.src_pattern)
        found = value(layout)
        chosen = F.when(test, found) if chosen is None else chosen.when(test, found)
    return chosen.otherwise(missing)


def mask_by_layout(lines: DataFrame, layouts: Sequence[Layout]) -> DataFrame:
    """Mask each source by the first layout whose ``src_pattern`` is found in its name."""
    return lines.withColumn("line", _by_layout(layouts, lambda x: x.masked(F.col("line"))))


def mask_audit(lines: DataFrame, layouts: Sequence[Layout]) -> DataFrame:
    """Per source: ``rows``, ``rows_masked`` and ``chars_masked`` of unmasked ``lines``.

    A masked character is a letter or digit inside a masked range or field.
    """
    chars = _by_layout(layouts, lambda x: x.masked_chars(F.col("line"))).cast("long")
    return (
        lines.select("src", chars.alias("chars"))
        .groupBy("src")
        .agg(
            F.count(F.lit(1)).alias("rows"),
            F.count_if(F.col("chars") > 0).alias("rows_masked"),
            F.coalesce(F.sum("chars"), F.lit(0)).alias("chars_masked"),
        )
    )
