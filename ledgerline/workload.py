"""The registered queries: each operator run over whole given tables, or inputs derived from them.

Every function takes the session and the folder of the tables. Files and archives that a query
reads are first written from the tables to the shared folder.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline import fixtures as fx
from ledgerline.functions.dates import business_date_list, business_dates
from ledgerline.functions.text import collapse_whitespace
from ledgerline.operators import blocks, deliveries, idmap, masking, merging, search, sections
from ledgerline.operators.layouts import mask_by_table
from ledgerline.plans import deliveries as delivery_plans
from ledgerline.plans import files, merge
from ledgerline.scale import new_shared_path
from ledgerline.sinks.text import read_written_lines, write_lines, write_scanned_lines
from ledgerline.sinks.versions import read_version
from ledgerline.sources.archives import zip_entries, zip_lines
from ledgerline.sources.lines import (
    explode_lines,
    list_files,
    read_counted_lines,
    read_lines,
    read_numbered_lines,
)
from ledgerline.streaming.masking import mask_stream, stream_lines

# Parameters of the queries; the oracles use the same.
CODE = "BUILDING"
CODES = ("AUTOMOBILE", "HOUSEHOLD", "B", "NONE")
PATTERN = "(licen[cs]e|eau)[a-z]*"
WIDE_RANGES = ((0, 4), (3, 9), (40, 59))
SERVER = "server-1"

QUERIES = {}


def query(function):
    QUERIES[function.__name__] = function
    return function


# Sources


def _document_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return explode_lines(fx.table(spark, sf_dir, "documents"), "doc_id", "text")


def _feed_folder(spark: SparkSession, sf_dir: str) -> str:
    """The feed as text files, a folder per source."""
    folder = new_shared_path(spark, "feed")
    write_lines(fx.feed_lines(spark, sf_dir), folder)
    return folder


def _source_of(path: Column) -> Column:
    return F.regexp_extract(path, "/src=([^/]+)/", 1)


@query
def lines_from_documents(spark, sf_dir):
    return _document_lines(spark, sf_dir)


@query
def lines_from_files(spark, sf_dir):
    lines = read_lines(spark, "*/*/*.txt", _feed_folder(spark, sf_dir))
    return lines.select(_source_of(F.col("src")).alias("src"), "line")


@query
def lines_back_slash_path(spark, sf_dir):
    """A folder named with back-slashes, one of them at its end."""
    folder = _feed_folder(spark, sf_dir).replace("/", "\\") + "\\"
    lines = read_lines(spark, "*.txt", folder, recursive=True)
    return lines.select(_source_of(F.col("src")).alias("src"), "line")


@query
def lines_numbered(spark, sf_dir):
    return read_written_lines(spark, _feed_folder(spark, sf_dir))


@query
def lines_numbered_per_file(spark, sf_dir):
    """Numbers of each file are 1 to n: their count and sum, added up per source."""
    lines = read_numbered_lines(spark, "*/*/*.txt", _feed_folder(spark, sf_dir))
    per_file = lines.groupBy("src").agg(
        F.count(F.lit(1)).alias("n"),
        F.sum("line_no").alias("total"),
        F.max("line_no").alias("last"),
    )
    sound = (F.col("last") == F.col("n")) & (2 * F.col("total") == F.col("n") * (F.col("n") + 1))
    return per_file.groupBy(_source_of(F.col("src")).alias("src")).agg(
        F.sum("n").alias("lines"), F.bool_and(sound).alias("sound")
    )


@query
def file_sizes(spark, sf_dir):
    listed = list_files(spark, "*.txt", _feed_folder(spark, sf_dir) + "/*/*")
    return listed.groupBy(_source_of(F.col("src")).alias("src")).agg(F.sum("bytes").alias("bytes"))


def _archive_name(path: Column) -> Column:
    return F.regexp_extract(path, r"([^/]+\.zip)", 1)


@query
def zip_entry_list(spark, sf_dir):
    entries = zip_entries(spark, "*.zip", fx.pack_documents(spark, sf_dir))
    return entries.select(_archive_name(F.col("archive")).alias("archive"), "entry", "bytes")


@query
def zip_line_list(spark, sf_dir):
    lines = zip_lines(spark, "*.zip", fx.pack_documents(spark, sf_dir))
    return lines.select(
        _archive_name(F.col("archive")).alias("archive"), "entry", "line_no", "line"
    )


@query
def recent_business_dates(spark, sf_dir):
    """The dates looked back at from every order date."""
    orders = fx.table(spark, sf_dir, "orders")
    days = orders.select(F.to_date("o_orderdate").alias("as_of")).distinct()
    return days.select(
        "as_of", F.explode(business_dates(F.col("as_of"), fx.LOOKBACK_DAYS)).alias("business_date")
    )


@query
def recent_business_dates_exact(spark, sf_dir):
    """Exactly three weekdays before every order date."""
    orders = fx.table(spark, sf_dir, "orders")
    days = orders.select(F.to_date("o_orderdate").alias("as_of")).distinct()
    return days.select(
        "as_of", F.explode(business_dates(F.col("as_of"), 3, "business")).alias("business_date")
    )


# Masking


def _layouts():
    return [
        masking.delimited("|", src_pattern="^[FOP]$"),
        masking.fixed(src_pattern="^NATION"),
    ]


def _mixed_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fx.feed_lines(spark, sf_dir).unionByName(fx.delimited_lines(spark, sf_dir))


@query
def mask_fixed(spark, sf_dir):
    return masking.mask_fixed(fx.feed_lines(spark, sf_dir))


@query
def mask_fixed_wide(spark, sf_dir):
    """Overlapping ranges over all document lines."""
    return masking.mask_fixed(_document_lines(spark, sf_dir), WIDE_RANGES)


@query
def mask_delimited(spark, sf_dir):
    return masking.mask_delimited(fx.delimited_lines(spark, sf_dir), "|")


@query
def mask_by_layout(spark, sf_dir):
    return masking.mask_by_layout(_mixed_lines(spark, sf_dir), _layouts())


@query
def mask_by_layout_table(spark, sf_dir):
    """The layouts as a table: one per order status, the rest by one for all nations."""
    lines = _mixed_lines(spark, sf_dir)
    sources = lines.select("src").distinct()
    return mask_by_table(lines, fx.layout_table(spark, sf_dir), sources)


@query
def mask_audit(spark, sf_dir):
    return masking.mask_audit(_mixed_lines(spark, sf_dir), _layouts())


@query
def mask_round_trip(spark, sf_dir):
    """Masked lines written per source and read back in order."""
    out = new_shared_path(spark, "masked")
    write_lines(masking.mask_fixed(fx.feed_lines(spark, sf_dir)), out)
    return read_written_lines(spark, out)


@query
def mask_files_in_place(spark, sf_dir):
    """Masked copies written by the reading tasks, without a shuffle, and read back."""
    out = new_shared_path(spark, "masked-files")
    lines = read_lines(spark, "*/*/*.txt", _feed_folder(spark, sf_dir))
    part = F.regexp_extract("src", r"/block=(\d+)/", 1)
    named = lines.withColumn("src", F.concat(_source_of(F.col("src")), F.lit("#"), part))
    write_scanned_lines(masking.mask_fixed(named), out)
    copies = read_written_lines(spark, out)
    return copies.select(F.substring_index("src", "#", 1).alias("src"), "line")


@query
def mask_streamed(spark, sf_dir):
    """Files masked by a streaming query that handles all that is there and stops."""
    lines = stream_lines(spark, _feed_folder(spark, sf_dir) + "/*/*")
    named = lines.withColumn("src", _source_of(F.col("src")))
    out = new_shared_path(spark, "masked-stream")
    writer = mask_stream(named, _layouts(), out, new_shared_path(spark, "stream-state"))
    writer.trigger(availableNow=True).start().awaitTermination()
    return read_written_lines(spark, out)


@query
def whitespace_collapsed(spark, sf_dir):
    pages = fx.table(spark, sf_dir, "pages")
    return pages.select("page_id", collapse_whitespace(F.col("html")).alias("text"))


# Customer blocks


@query
def filter_detail_records(spark, sf_dir):
    return blocks.filter_detail_records(fx.feed_lines(spark, sf_dir))


@query
def parse_holder_records(spark, sf_dir):
    return blocks.parse_holder_records(
        blocks.filter_detail_records(fx.feed_lines(spark, sf_dir))
    )


@query
def customer_block_bounds(spark, sf_dir):
    return blocks.block_bounds(fx.feed_lines(spark, sf_dir), [CODE])


@query
def customer_block(spark, sf_dir):
    lines = fx.feed_lines(spark, sf_dir)
    staged = blocks.stage_blocks(blocks.block_bounds(lines, [CODE]))
    return blocks.block_lines(lines, staged)


@query
def extract_customer(spark, sf_dir):
    return files.extract_customer(fx.feed_lines(spark, sf_dir), CODE).records


@query
def customer_export_lines(spark, sf_dir):
    return files.extract_customer(fx.feed_lines(spark, sf_dir), CODE).export


@query
def customer_export_files(spark, sf_dir):
    """Export lines written per source and code and read back in order."""
    out = new_shared_path(spark, "exports")
    extract = files.extract_customers(fx.feed_lines(spark, sf_dir), CODES)
    write_lines(extract.export, out, ("src", "code"))
    return read_written_lines(spark, out, ("src", "code"))


@query
def customers_multi(spark, sf_dir):
    """Several codes in one pass; one is part of another customer's code, one is absent."""
    return files.extract_customers(fx.feed_lines(spark, sf_dir), CODES).records


@query
def customers_status(spark, sf_dir):
    return files.extract_customers(fx.feed_lines(spark, sf_dir), CODES).status


@query
def customers_by_field(spark, sf_dir):
    """All customers of all sources, found by the whole code field."""
    lines = fx.feed_lines(spark, sf_dir)
    staged = blocks.stage_blocks(blocks.block_bounds(lines, None, "field", fx.CODE_FIELD))
    return blocks.parse_holder_records(
        blocks.block_lines(blocks.filter_detail_records(lines), staged)
    )


@query
def customers_by_table(spark, sf_dir):
    """Customers named in a table of codes, with their outcome."""
    latest = fx.table(spark, sf_dir, "customer").groupBy("c_mktsegment").agg(
        F.max("c_custkey").alias("last")
    )
    codes = latest.filter("last % 2 = 0").select(F.col("c_mktsegment").alias("code"))
    return files.extract_customers(fx.feed_lines(spark, sf_dir), codes, match="field", field=fx.CODE_FIELD).status


@query
def customers_long_codes(spark, sf_dir):
    """All customers of a feed whose codes are longer, found by their field, with their outcome."""
    lines = fx.feed_lines(spark, sf_dir, long_codes=True)
    return files.extract_customers(lines, None, match="field", field=fx.LONG_CODE_FIELD).status


def _long_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fx.feed_lines(spark, sf_dir, long_codes=True)


@query
def customers_by_pattern(spark, sf_dir):
    """Customers found by a table of patterns: with certain plain text, without it, and of no customer."""
    return files.extract_customers(_long_feed(spark, sf_dir), fx.code_patterns(spark, sf_dir)).status


@query
def customers_by_plain_text(spark, sf_dir):
    """Customers found by a table of plain texts, one per customer account."""
    codes = fx.code_patterns(spark, sf_dir, plain=True)
    return files.extract_customers(_long_feed(spark, sf_dir), codes, match="literal").status


# Sections


@query
def split_sections(spark, sf_dir):
    return sections.split_sections(fx.feed_lines(spark, sf_dir), 2, 1)


@query
def split_document_sections(spark, sf_dir):
    """Short documents, where header and trailer share lines."""
    return sections.split_sections(_document_lines(spark, sf_dir), 3, 2)


@query
def section_counts(spark, sf_dir):
    return sections.section_counts(_document_lines(spark, sf_dir), 3, 2)


@query
def split_sections_negative(spark, sf_dir):
    """A trailer count may be given as a negative number."""
    return sections.split_sections(fx.feed_lines(spark, sf_dir), 2, -1)


@query
def empty_sources(spark, sf_dir):
    """Sizes and section counts of files, those without content and with hidden names included."""
    folder = fx.document_files(spark, sf_dir)
    sizes = list_files(spark, "*.txt", folder, hidden=True).select(F.col("name").alias("src"), "bytes")
    read = read_counted_lines(spark, "*.txt", folder, names="name", hidden=True)
    counts = sections.section_counts(read.lines, 1, 1, read.counts)
    return sizes.join(counts, "src")


@query
def masked_copies_named(spark, sf_dir):
    """Masked copies of files under names of their own: sizes and lines of every copy."""
    folder, out = fx.document_files(spark, sf_dir), new_shared_path(spark, "copies")
    files.mask_files(spark, "*.txt", folder, [masking.fixed()], out, named=True)
    return _written_files(spark, out)


@query
def section_files_named(spark, sf_dir):
    """Sections of every file under names of their own, empty ones too: sizes and lines."""
    folder, out = fx.document_files(spark, sf_dir), new_shared_path(spark, "sections-named")
    files.split_files(spark, "*.txt", folder, out, 2, 1, hidden=True, named=True)
    return _written_files(spark, out)


def _written_files(spark: SparkSession, out: str) -> DataFrame:
    """Per file below a folder: its bytes, its lines, and a hash of each line with its number, added up."""
    sizes = list_files(spark, "*", out, hidden=True).select(F.col("name").alias("src"), "bytes")
    lines = read_numbered_lines(spark, "*", out, names="name", hidden=True)
    mark = F.conv(F.substring(F.md5(F.concat_ws("|", F.col("line_no").cast("string"), "line")), 1, 8), 16, 10)
    sums = lines.groupBy("src").agg(F.count(F.lit(1)).alias("lines"), F.sum(mark.cast("long")).alias("marks"))
    none = F.lit(0).cast("long")
    return sizes.join(sums, "src", "left").select(
        "src", "bytes", F.coalesce("lines", none).alias("lines"), F.coalesce("marks", none).alias("marks")
    )


@query
def lines_wide_encoding(spark, sf_dir):
    """The feed in UTF-16, written whole per source, read back by byte ranges."""
    folder = fx.wide_feed(spark, sf_dir)
    return read_numbered_lines(spark, "*.txt", folder, encoding="UTF-16", names="name")


@query
def lines_unicode_breaks(spark, sf_dir):
    """Lines of files that also end at further Unicode breaks."""
    return read_numbered_lines(
        spark, "*.txt", fx.document_files(spark, sf_dir), names="name", unicode_breaks=True, hidden=True
    )


@query
def section_files_in_place(spark, sf_dir):
    """Every feed file split by the tasks that read it, and read back."""
    out = new_shared_path(spark, "split-files")
    files.split_files(spark, "*.txt", _feed_folder(spark, sf_dir), out, 2, 1, recursive=True)
    written = read_written_lines(spark, out, ("src", "section"))
    source = F.regexp_extract("src", "src=([^/]+)/", 1)
    block = F.regexp_extract("src", r"/block=(\d+)/", 1).cast("long").cast("string")
    return written.withColumn("src", F.concat_ws("/", source, block))


@query
def section_files(spark, sf_dir):
    """Sections written per source and read back in order."""
    out = new_shared_path(spark, "sections")
    split = sections.split_sections(fx.feed_lines(spark, sf_dir), 2, 1)
    write_lines(split, out, ("src", "section"))
    return read_written_lines(spark, out, ("src", "section"))


# Search


@query
def search_lines(spark, sf_dir):
    return search.flat_matches(search.search_lines(_document_lines(spark, sf_dir), PATTERN))


@query
def search_files(spark, sf_dir):
    """Matches with line numbers in many files."""
    found = files.search_files(spark, "*/*/*.txt", _feed_folder(spark, sf_dir), "d10[57]0101")
    return search.flat_matches(found).withColumn("src", _source_of(F.col("src")))


@query
def search_zip(spark, sf_dir):
    found = files.search_zip(spark, "*.zip", fx.pack_documents(spark, sf_dir), PATTERN)
    return search.flat_matches(found).withColumn(
        "path", F.regexp_extract("path", r"([^/]+\.zip.*)", 1)
    )


# Missing deliveries


def _dates(spark: SparkSession):
    return business_date_list(spark, fx.AS_OF, fx.LOOKBACK_DAYS)


def _names(tables: dict[str, DataFrame]) -> list[DataFrame]:
    return [tables[n] for n in ("brokers", "accounts", "users", "customers")]


@query
def active_broker_accounts(spark, sf_dir):
    tables = fx.report_tables(spark, sf_dir)
    return deliveries.active_broker_accounts(*_names(tables), _dates(spark))


@query
def expected_deliveries(spark, sf_dir):
    tables = fx.report_tables(spark, sf_dir)
    return deliveries.expected_deliveries(*_names(tables), _dates(spark))


@query
def processed_deliveries(spark, sf_dir):
    tables = fx.report_tables(spark, sf_dir)
    return deliveries.processed_deliveries(*_names(tables), tables["daily"], _dates(spark))


@query
def unprocessed_deliveries(spark, sf_dir):
    return deliveries.unprocessed_deliveries(
        expected_deliveries(spark, sf_dir), processed_deliveries(spark, sf_dir)
    )


@query
def exceptions_report(spark, sf_dir):
    tables = fx.report_tables(spark, sf_dir)
    return delivery_plans.exceptions_report(
        *_names(tables), tables["daily"], fx.AS_OF, fx.LOOKBACK_DAYS, SERVER
    )


@query
def exceptions_report_text_ids(spark, sf_dir):
    """The report over text ids that differ in case from table to table."""
    tables = {name: fx.text_ids(t, i) for i, (name, t) in enumerate(fx.report_tables(spark, sf_dir).items())}
    return delivery_plans.exceptions_report(
        *_names(tables), tables["daily"], fx.AS_OF, fx.LOOKBACK_DAYS, SERVER
    )


# Identifier merge


@query
def id_map_resolved(spark, sf_dir):
    return idmap.resolve_id_map(fx.id_map(spark, sf_dir)).df


def _matched(spark: SparkSession, sf_dir: str, name: str) -> merging.Matched:
    resolved = idmap.resolve_id_map(fx.id_map(spark, sf_dir))
    return merging.match(fx.merge_tables(spark, sf_dir)[name], resolved, "guid")


@query
def merge_trades(spark, sf_dir):
    return merging.repoint(_matched(spark, sf_dir, "trades"))


@query
def merge_daily_process(spark, sf_dir):
    return merging.repoint_balances(_matched(spark, sf_dir, "daily"), "balance")


@query
def merge_archive(spark, sf_dir):
    return merging.repoint(_matched(spark, sf_dir, "archive"))


@query
def merge_holdings(spark, sf_dir):
    return merging.remove(_matched(spark, sf_dir, "holdings"))


@query
def merge_audit(spark, sf_dir):
    tables = fx.merge_tables(spark, sf_dir)
    return merge.merge_ids(
        **tables, id_map=fx.id_map(spark, sf_dir), key="guid", balance="balance"
    ).audit


@query
def merge_literal_map(spark, sf_dir):
    """A map written out as rows, applied to all trades."""
    entries = spark.createDataFrame(
        [(1, 1, 2), (2, 2, 3), (3, 5, None), (4, 4, 1)], "seq long, old_id long, new_id long"
    )
    trades = fx.merge_tables(spark, sf_dir)["trades"].select("o_orderkey", "guid")
    return merging.repoint(merging.match(trades, idmap.resolve_id_map(entries), "guid"))


@query
def merge_text_ids(spark, sf_dir):
    """The merge over text ids in mixed case: rows and different spellings of keys per table."""
    tables = {
        name: fx.text_ids(t, i, ("guid",)) for i, (name, t) in enumerate(fx.merge_tables(spark, sf_dir).items())
    }
    entries = fx.text_ids(fx.id_map(spark, sf_dir), 7, ("old_id", "new_id"))
    done = merge.merge_ids(**tables, id_map=entries, key="guid", balance="balance")
    united = None
    for name in ("trades", "daily", "archive", "holdings"):
        one = getattr(done, name).agg(
            F.lit(name).alias("table_name"),
            F.count(F.lit(1)).alias("rows"),
            F.count_distinct("guid").alias("keys"),
            F.sum(F.regexp_extract("guid", r"(\d+)", 1).cast("long")).alias("key_sum"),
        )
        united = one if united is None else united.unionByName(one)
    return united


@query
def merge_committed(spark, sf_dir):
    """The merge written as one version and read back: rows and sum of keys per table."""
    out = new_shared_path(spark, "merged")
    merge.merge_ids(
        **fx.merge_tables(spark, sf_dir),
        id_map=fx.id_map(spark, sf_dir),
        commit=True,
        out=out,
        key="guid",
        balance="balance",
    )
    written = read_version(spark, out)
    united = None
    for name in ("trades", "daily", "archive", "holdings"):
        one = written[name].agg(
            F.lit(name).alias("table_name"),
            F.count(F.lit(1)).alias("rows"),
            F.sum("guid").cast("long").alias("key_sum"),
            F.count_if(F.col("guid").isNull()).alias("null_keys"),
        )
        united = one if united is None else united.unionByName(one)
    return united
