"""Jobs on text files and archives, from an input mask to results or output folders.

Outputs are folders per source, named by the path of the file below the input folder, or with ``named``
plain files; inputs are never written to, so a second run sees the same files. Files without content are
in all reports; as plain files they are written empty, in folders they have none.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.operators import blocks, masking, search, sections
from ledgerline.operators.layouts import audit_by_table, mask_by_table
from ledgerline.operators.masking import Layout
from ledgerline.operators.ranges import bucket_of
from ledgerline.scale import stage
from ledgerline.sinks.named import prefixed, write_files
from ledgerline.sinks.text import write_lines, write_scanned_lines
from ledgerline.sources import rangeread
from ledgerline.sources.archives import zip_lines
from ledgerline.sources.lines import read_counted_lines, read_lines, read_numbered_lines, source_name
from ledgerline.sources.listing import listing


def mask_files(
    spark: SparkSession,
    mask: str,
    path: str,
    layouts: Sequence[Layout] | DataFrame,
    out: str,
    *,
    recursive: bool = False,
    encoding: str = "UTF-8",
    hidden: bool = True,
    named: bool = False,
) -> DataFrame:
    """Write masked copies of all matching files below ``out`` and return the audit per source.

    One pass over the files, without a shuffle of lines, writes the copies; the audit is lazy. ``layouts``
    may be a table, see ``operators.layouts``. Names with a dot in front are matched by any mask unless
    ``hidden`` is off. With ``named`` the copy of ``folder/file`` is the file ``folder/m_file``, with a line
    end after the last line if the file has one.
    """
    options = dict(recursive=recursive, hidden=hidden)
    lines = read_lines(spark, mask, path, encoding=encoding, names="relative", **options)
    found = listing(spark, mask, path, **options).files
    sources = found.select(source_name(spark, "relative", path, F.col("path"), encoded=False).alias("src"), "path", "bytes")
    full = sources.filter("bytes > 0")
    if isinstance(layouts, DataFrame):
        masked = mask_by_table(lines, layouts, full)
        audit = audit_by_table(lines, layouts, full)
    else:
        masked = masking.mask_by_layout(lines, layouts)
        audit = masking.mask_audit(lines, layouts)
    if named:
        files = _copies(full, encoding).unionByName(
            sources.filter("bytes = 0").select("src", F.lit(False).alias("cut"))
        )
        file = prefixed(F.col("src"), "m_").alias("file")
        write_files(masked.select(file, "block", "pos", "line"), files.select(file, "cut"), out)
    else:
        write_scanned_lines(masked, out)
    none = [F.lit(0).cast("long").alias(c) for c in audit.columns if c != "src"]
    return audit.unionByName(sources.filter("bytes = 0").select("src", *none))


def _copies(files: DataFrame, encoding: str) -> DataFrame:
    """``src`` and ``cut``: whether a copy ends without a line end, like its file. Packed files end with one."""
    endings = "|".join(e[1:] for e in rangeread.PACKED)
    packed = F.lower("path").rlike(rf"\.({endings})$")
    given = files.filter(~packed).select("src", F.col("path").alias("f"), "bytes")
    ended = given.mapInArrow(partial(rangeread.ended_rows, encoding=encoding), "src string, ended boolean")
    return ended.select("src", (~F.col("ended")).alias("cut")).unionByName(
        files.filter(packed).select("src", F.lit(False).alias("cut"))
    )


@dataclass(frozen=True)
class Extract:
    """Holder records of customers, the text lines to export, and the outcome per source."""

    bounds: DataFrame
    records: DataFrame
    export: DataFrame
    status: DataFrame


def extract_customers(
    lines: DataFrame,
    codes: blocks.Codes,
    *,
    match: str = "regex",
    field: blocks.Field = None,
    provider: str = blocks.PROVIDER,
    sources: DataFrame | None = None,
    quote: str | None = None,
    staged: bool = False,
) -> Extract:
    """Blocks of the customers in ``codes`` from numbered feed ``lines``, parsed.

    ``records`` has ``src``, ``code``, ``line_no`` and the holder columns. ``sources`` (one row per
    ``src``) also lists sources without any line in ``status``. With ``quote`` exported values that
    hold the delimiter or the quote itself are quoted. ``staged`` writes the detail rows of the blocks to
    the shared folder, so that export and status, both needed, do not read the feed again.
    """
    bounds = blocks.block_bounds(lines, codes, match, field)
    held = blocks.stage_blocks(bounds)
    details = blocks.block_lines(blocks.filter_detail_records(lines), held)
    if staged:
        details = stage(details, "block-records").df  # tasks without such rows write no file
    records = blocks.parse_holder_records(details, provider)
    return Extract(
        bounds=bounds,
        records=records,
        export=blocks.export_lines(records, bounds, quote=quote),
        status=blocks.block_status(lines if sources is None else sources, bounds, details, codes),
    )


def extract_customer(lines: DataFrame, code: str, **options) -> Extract:
    """One customer's block; see ``extract_customers``."""
    return extract_customers(lines, [code], **options)


def extract_customer_files(
    spark: SparkSession,
    mask: str,
    path: str,
    codes: blocks.Codes,
    out: str,
    *,
    recursive: bool = False,
    encoding: str = "UTF-8",
    unicode_breaks: bool = False,
    hidden: bool = False,
    named: bool = False,
    **options,
) -> DataFrame:
    """Write each customer's records below ``out/src=.../code=.../`` and return the status.

    The feed is read three times: for line counts, for the bounds of blocks and for what lies in them.
    With ``named`` they are the plain files ``<file>.<code>.txt``. ``options`` are those of
    ``extract_customers``.
    """
    read = read_counted_lines(
        spark, mask, path, recursive=recursive, encoding=encoding, names="relative", unicode_breaks=unicode_breaks, hidden=hidden
    )
    extract = extract_customers(read.lines, codes, sources=read.counts, staged=True, **options)
    if named:
        plain = F.when(~F.col("code").contains("/"), F.col("code"))  # a code with a slash is no file name
        file = F.concat("src", F.lit("."), plain, F.lit(".txt")).alias("file")
        rows = extract.export.select(file, bucket_of("line_no").alias("block"), "line_no", "line")
        ends = extract.bounds.filter("end_line is not null").select(file, F.lit(False).alias("cut"))
        write_files(rows, ends, out, "line_no", scanned=False)
    else:
        write_lines(extract.export, out, ("src", "code"))
    return extract.status


def split_files(
    spark: SparkSession,
    mask: str,
    path: str,
    out: str,
    header: int = 0,
    trailer: int = 0,
    *,
    recursive: bool = False,
    encoding: str = "UTF-8",
    unicode_breaks: bool = False,
    hidden: bool = False,
    named: bool = False,
) -> DataFrame:
    """Write the sections of all matching files below ``out/src=.../section=.../``; return counts.

    One pass counts the lines and a second one writes them, without a shuffle. With ``named`` the sections
    are the plain files ``<file>.<section>.txt``, all three of every file, without a line end after the
    last line.
    """
    read = read_counted_lines(
        spark, mask, path, recursive=recursive, encoding=encoding, names="relative", unicode_breaks=unicode_breaks, hidden=hidden
    )
    split = sections.split_sections(read.sized, header, trailer)
    if named:
        file = F.concat("src", F.lit("."), "section", F.lit(".txt")).alias("file")
        every = F.explode(F.array(*[F.lit(x) for x in sections.SECTIONS])).alias("section")
        files = read.counts.select("src", every).select(file, F.lit(True).alias("cut"))
        write_files(split.select(file, "block", "line_no", "line"), files, out, "line_no")
    else:
        write_scanned_lines(split, out, ("src", "section"), "line_no")
    return sections.section_counts(read.lines, header, trailer, read.counts)


def search_files(
    spark: SparkSession,
    mask: str,
    path: str,
    pattern: str,
    *,
    recursive: bool = False,
    encoding: str = "UTF-8",
    unicode_breaks: bool = False,
) -> DataFrame:
    """Matches in the lines of all matching files."""
    lines = read_numbered_lines(
        spark, mask, path, recursive=recursive, encoding=encoding, unicode_breaks=unicode_breaks
    )
    return search.search_lines(lines, pattern)


def search_zip(
    spark: SparkSession,
    mask: str,
    path: str,
    pattern: str,
    *,
    separator: str = "\\",
    groups: int = 0,
    recursive: bool = False,
) -> DataFrame:
    """Matches in the lines of all files in all matching archives."""
    lines = zip_lines(spark, mask, path, recursive=recursive)
    return search.search_archive_lines(lines, pattern, separator, groups)
