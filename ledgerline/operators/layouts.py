"""Masking by layouts that come as a table.

A layout row has ``seq`` (the order of trial), ``src_pattern``, ``kind`` (F or D), ``ranges`` (array of
structs ``first``, ``last``: 0-based, both included), ``delimiter``, ``columns`` (array of 0-based
numbers) and ``row_prefix`` (null: all rows). The layout of a source is chosen once per source, by the
first pattern found in its name; lines are then joined to it by their source, and masked by functions
over the arrays, so neither patterns nor expressions grow with the table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.functions import text as tx
from ledgerline.scale import Staged, skew_join, stage

LAYOUT = (
    "struct<seq: bigint, src_pattern: string, kind: string, ranges: array<struct<first: int, last: int>>, "
    "delimiter: string, columns: array<int>, row_prefix: string>"
)
_RANGES = "array<struct<first: int, last: int>>"


def _united(ranges: Column) -> Column:
    """Union of ranges, in order and without overlap."""

    def add(done: Column, r: Column) -> Column:
        last = F.try_element_at(done, F.lit(-1))
        touching = (F.size(done) > 0) & (r["first"] <= last["last"] + 1)
        grown = F.struct(last["first"].alias("first"), F.greatest(last["last"], r["last"]).alias("last"))
        joined = F.concat(F.slice(done, 1, F.size(done) - 1), F.array(grown))
        return F.when(touching, joined).otherwise(F.concat(done, F.array(r)))

    return F.aggregate(F.array_sort(ranges), F.array().cast(_RANGES), add)


def checked(layouts: DataFrame) -> DataFrame:
    """The layouts in comparable form; a row that could leave data unmasked is an error."""
    kind = F.upper("kind")
    ranges = F.filter("ranges", lambda r: r.isNotNull())
    bad_range = F.exists(ranges, lambda r: F.coalesce((r["first"] < 0) | (r["last"] < r["first"]), F.lit(True)))
    columns = F.filter("columns", lambda c: c.isNotNull())
    empty = F.lit(0)
    wrong = (
        F.when(F.col("src_pattern").isNull(), "a layout without a source pattern")
        .when(~F.coalesce(kind.isin("F", "D"), F.lit(False)), "an unknown file structure")
        .when((kind == "F") & (F.coalesce(F.size(ranges), empty) < 1), "a fixed layout without ranges")
        .when((kind == "F") & bad_range, "a bad mask range")
        .when((kind == "D") & (F.coalesce(F.length("delimiter"), empty) == 0), "a delimited layout needs a delimiter")
        .when((kind == "D") & (F.coalesce(F.size(columns), empty) < 1), "a delimited layout without fields")
        .when((kind == "D") & F.exists(columns, lambda c: c < 0), "a bad field number")
    )
    sound = F.when(wrong.isNull(), kind).otherwise(F.raise_error(wrong).cast("string"))
    return layouts.select(
        F.col("seq").cast("long").alias("seq"),
        "src_pattern",
        sound.alias("kind"),
        F.when(kind == "F", _united(ranges.cast(_RANGES))).alias("ranges"),
        "delimiter",
        columns.cast("array<int>").alias("columns"),
        "row_prefix",
    )


def source_layouts(sources: DataFrame, layouts: DataFrame) -> Staged:
    """``src`` and ``layout`` (as text) of every source; a source that no pattern fits is an error.

    The table of layouts is read as one value, so it takes no join.
    """
    table = checked(layouts)
    every = table.agg(F.array_sort(F.collect_list(F.struct(*table.columns))).alias("every"))
    every = F.coalesce(every.scalar(), F.array().cast(f"array<{LAYOUT}>"))
    fits = F.filter("every", lambda x: F.rlike(F.col("src"), x["src_pattern"]))
    first = F.try_element_at(fits, F.lit(1))
    missing = F.raise_error(F.concat(F.lit("no mask layout for source "), F.col("src"))).cast("string")
    chosen = F.when(F.size(fits) > 0, F.to_json(first)).otherwise(missing)
    tried = sources.select("src").distinct().withColumn("every", every)
    return stage(tried.select("src", chosen.alias("layout")), "source-layouts")


def _masked_ranges(line: Column, ranges: Column) -> Column:
    start = F.struct(F.lit("").alias("text"), F.lit(0).alias("done"))

    def add(state: Column, r: Column) -> Column:
        before = F.substring(line, state["done"] + 1, r["first"] - state["done"])
        inside = F.substring(line, r["first"] + 1, r["last"] - r["first"] + 1)
        text = F.concat(state["text"], before, tx.mask_text(inside))
        return F.struct(text.alias("text"), (r["last"] + 1).alias("done"))

    def rest(state: Column) -> Column:
        return F.concat(state["text"], F.substring(line, state["done"] + 1, F.length(line)))

    return F.aggregate(ranges, start, add, rest)


def _range_text(line: Column, ranges: Column) -> Column:
    cut = F.transform(ranges, lambda r: F.substring(line, r["first"] + 1, r["last"] - r["first"] + 1))
    return F.array_join(cut, "")


def _fields(line: Column, delimiter: Column) -> Column:
    quoted = F.concat(F.lit("\\Q"), F.replace(delimiter, F.lit("\\E"), F.lit("\\E\\\\E\\Q")), F.lit("\\E"))
    return F.split(line, quoted, -1)


def _with_layouts(lines: DataFrame, chosen: Staged) -> DataFrame:
    joined = skew_join(lines, chosen, ["src"], "left")
    return joined.withColumn("layout", F.from_json("layout", LAYOUT))


def _applies(line: Column, layout: Column) -> Column:
    return layout["row_prefix"].isNull() | line.startswith(layout["row_prefix"])


def mask_by_table(lines: DataFrame, layouts: DataFrame, sources: DataFrame | None = None) -> DataFrame:
    """Mask each source by the first layout of the table whose pattern is found in its name.

    ``sources`` (with ``src``) spares a pass over the lines for their names.
    """
    line, layout = F.col("line"), F.col("layout")
    fields = F.transform(
        _fields(line, layout["delimiter"]),
        lambda x, i: F.when(F.array_contains(layout["columns"], i), tx.mask_text(x)).otherwise(x),
    )
    done = F.when(layout["kind"] == "F", _masked_ranges(line, layout["ranges"])).otherwise(
        F.call_function("array_join", fields, layout["delimiter"])
    )
    chosen = source_layouts(lines if sources is None else sources, layouts)
    masked = F.when(_applies(line, layout), done).otherwise(line)
    return _with_layouts(lines, chosen).withColumn("line", masked).select(*lines.columns)


def audit_by_table(lines: DataFrame, layouts: DataFrame, sources: DataFrame | None = None) -> DataFrame:
    """Per source: ``rows``, ``rows_masked`` and ``chars_masked`` of unmasked ``lines``."""
    line, layout = F.col("line"), F.col("layout")
    wanted = F.filter(
        _fields(line, layout["delimiter"]), lambda _, i: F.array_contains(layout["columns"], i)
    )
    text = F.when(layout["kind"] == "F", _range_text(line, layout["ranges"])).otherwise(F.array_join(wanted, ""))
    chosen = source_layouts(lines if sources is None else sources, layouts)
    chars = F.when(_applies(line, layout), tx.maskable_chars(text)).otherwise(0).cast("long")
    counted = _with_layouts(lines, chosen).select("src", chars.alias("chars"))
    return counted.groupBy("src").agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_if(F.col("chars") > 0).alias("rows_masked"),
        F.coalesce(F.sum("chars"), F.lit(0)).alias("chars_masked"),
    )
