"""Inputs derived by Spark from the given tables, for the registered queries, tests and bench.

They grow with the tables and hold the cases the operators are about: customer blocks in shared
feeds, chained and repeated map entries, zero and null balances, archives of text files.
"""

from __future__ import annotations

import datetime as dt
from functools import partial

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.scale import new_shared_path, stage
from ledgerline.sources import zippack
from ledgerline.sources.lines import number_rows

cloudpickle.register_pickle_by_value(zippack)

AS_OF = dt.date(2001, 7, 28)
LOOKBACK_DAYS = 7
DOCUMENTS_PER_ARCHIVE = 250
# Where the feeds hold the code in header and trailer lines: 0-based start, length.
CODE_FIELD = (2, 12)
LONG_CODE_FIELD = (2, 40)
_CUSTOMERS_PER_BUCKET = 1 << 16
# Keeps the parts of the map in order for any number of customers.
_STEP = 10**15


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def feed_rows(spark: SparkSession, sf_dir: str, long_codes: bool = False) -> DataFrame:
    """Feed lines before numbering: a source per nation, a customer block per market segment.

    Long codes begin with the name of the segment and the word SEGMENT, so many share 12 characters.
    Columns ``src``, ``code``, ``o`` (order within the block), ``line``.
    """
    people = table(spark, sf_dir, "customer").join(
        table(spark, sf_dir, "nation"), F.col("c_nationkey") == F.col("n_nationkey")
    ).select(
        F.col("n_name").alias("src"), F.col("c_mktsegment").alias("code"), F.col("c_custkey").alias("k")
    )
    width = CODE_FIELD[1]
    if long_codes:
        width = LONG_CODE_FIELD[1]
        people = people.withColumn("code", F.concat(F.lit("SEGMENT-NAMED-"), "code", F.lit("-"), "src"))
    code, key = F.rpad("code", width, " "), F.col("k").cast("string")
    blank = F.lit("")
    detail = F.concat(
        F.lit("D10"), (F.col("k") % 9 + 1).cast("string"), F.lit("0101"), F.lpad(key, 9, "0"),
        F.rpad(blank, 6, " "), F.rpad(F.concat(F.lit("  Holder   "), key), 67, " "),
        F.rpad(blank, 23, " "), F.rpad(F.concat(F.lit("Joint "), F.col("code")), 68, " "),
        F.rpad(blank, 23, " "), F.rpad(blank, 68, " "),
    )
    ends = people.select("src", "code").distinct().select(
        "src",
        "code",
        F.inline(
            F.array(
                F.struct(
                    F.lit(-1).cast("long").alias("o"),
                    F.concat(F.lit("CH"), code, F.lit("20240102")).alias("line"),
                ),
                F.struct(
                    F.lit(1 << 62).alias("o"), F.concat(F.lit("CT"), code, F.lit("END")).alias("line")
                ),
            )
        ),
    )
    return people.select("src", "code", F.col("k").alias("o"), detail.alias("line")).unionByName(ends)


def feed_lines(spark: SparkSession, sf_dir: str, long_codes: bool = False) -> DataFrame:
    """The feed as a lines relation."""
    bucket = F.struct("code", F.floor(F.col("o") / _CUSTOMERS_PER_BUCKET).alias("part"))
    numbered = number_rows(feed_rows(spark, sf_dir, long_codes), "src", ["code", "o"], bucket)
    return numbered.select("src", "line_no", "line")


def delimited_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pipe-delimited order lines, one source per order status: ``src``, ``line_no``, ``line``.

    Two rows in three start with D1. The line number is the order key.
    """
    key = F.col("o_orderkey")
    line = F.concat_ws(
        "|",
        F.when(key % 3 == 0, "H1").otherwise("D1"),
        key.cast("string"),
        F.col("o_custkey").cast("string"),
        F.col("o_orderstatus"),
        F.lit(""),
        F.concat(F.lit("Acct-"), F.col("o_custkey").cast("string")),
        F.col("o_orderpriority"),
        F.concat(F.lit("Clerk é#"), (key % 1000).cast("string")),
        F.date_format("o_orderdate", "yyyy-MM-dd"),
    )
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderstatus").alias("src"), key.alias("line_no"), line.alias("line")
    )


def document_files(spark: SparkSession, sf_dir: str) -> str:
    """Text files of ten documents each, and one without content for every fourth of them.

    Names are ``<number>.txt`` and ``_<number>.txt`` in turn, ``.<number>.txt`` for the empty ones.
    """
    folder = new_shared_path(spark, "documents")
    number = F.expr("doc_id div 10")
    texts = F.transform(F.array_sort(F.collect_list(F.struct("doc_id", "text"))), lambda d: d["text"])
    full = table(spark, sf_dir, "documents").groupBy(number.alias("k")).agg(F.array_join(texts, "\n").alias("text"))
    name = F.concat(F.when(F.col("k") % 2 == 1, "_").otherwise(""), F.col("k").cast("string"))
    empty = full.filter("k % 4 = 0").select(F.concat(F.lit("."), F.col("k").cast("string")).alias("name"), F.lit("").alias("text"))
    rows = full.select(name.alias("name"), "text").unionByName(empty)
    rows = rows.select(F.concat(F.lit(f"{folder}/"), "name", F.lit(".txt")).alias("file"), "text")
    stage(rows.mapInArrow(zippack.write_rows, "file string"), "written")
    return folder


def wide_feed(spark: SparkSession, sf_dir: str) -> str:
    """The feed in UTF-16, one file per source, each written by a task from its lines in order."""
    folder = new_shared_path(spark, "wide-feed")
    lines = feed_lines(spark, sf_dir)
    rows = lines.select(F.concat(F.lit(f"{folder}/"), "src", F.lit(".txt")).alias("file"), "line_no", "line")
    ordered = rows.repartition("file").sortWithinPartitions("file", "line_no").select("file", "line")
    stage(ordered.mapInArrow(partial(zippack.write_lines, encoding="utf-16-le"), "file string"), "written")
    return folder


def code_patterns(spark: SparkSession, sf_dir: str, plain: bool = False) -> DataFrame:
    """Table of codes for the feed with long codes: some of each customer block, some of none.

    Patterns begin with five letters of the segment, or are in parentheses; plain texts are parts of codes.
    """
    people = table(spark, sf_dir, "customer").join(
        table(spark, sf_dir, "nation"), F.col("c_nationkey") == F.col("n_nationkey")
    )
    segment, nation = F.col("c_mktsegment"), F.col("n_name")
    if plain:
        codes = F.array(F.concat(segment, F.lit("-"), nation), F.col("c_name"))
    else:
        open_end = F.concat(F.substring(segment, 1, 5), F.lit(".*-"), nation)
        codes = F.array(open_end, F.concat(F.lit("("), segment, F.lit(")-"), nation), F.concat(F.lit("No.+"), "c_name"))
    return people.select(F.explode(codes).alias("code"))


def layout_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mask layouts: a delimited one per order status, then a fixed one per market segment for all others."""
    statuses = table(spark, sf_dir, "orders").select(F.col("o_orderstatus").alias("s")).distinct()
    ranges = F.array(F.struct(F.lit(9).alias("first"), F.lit(16).alias("last")), F.struct(F.lit(7).alias("first"), F.lit(11).alias("last")))
    columns = F.array(*[F.lit(i) for i in (8, 5, 6, 7)])
    text, numbers = F.lit(None).cast("string"), F.lit(None).cast("array<int>")
    delimited = statuses.select(
        F.ascii("s").cast("long").alias("seq"), F.concat(F.lit("^"), "s", F.lit("$")).alias("src_pattern"),
        F.lit("d").alias("kind"), F.lit(None).cast(ranges_type()).alias("ranges"), F.lit("|").alias("delimiter"),
        columns.alias("columns"), F.lit("D1").alias("row_prefix"),
    )
    segments = table(spark, sf_dir, "customer").select(F.length("c_mktsegment").alias("n")).distinct()
    fixed = segments.select(
        (F.lit(1000) + F.col("n")).cast("long").alias("seq"), F.lit("^.").alias("src_pattern"), F.lit("F").alias("kind"),
        ranges.cast(ranges_type()).alias("ranges"), text.alias("delimiter"), numbers.alias("columns"), text.alias("row_prefix"),
    )
    return fixed.unionByName(delimited)


def ranges_type() -> str:
    return "array<struct<first: int, last: int>>"


def text_ids(frame: DataFrame, salt: int, columns: tuple[str, ...] | None = None) -> DataFrame:
    """The frame with its id columns as texts whose case depends on the number and ``salt``."""
    for c in columns or [c for c in frame.columns if c.endswith("GUID")]:
        text = F.concat(F.lit("Id-"), F.col(c).cast("string"))
        upper = (F.col(c) + salt) % 3 == 0
        frame = frame.withColumn(c, F.when(upper, F.upper(text)).otherwise(text))
    return frame


def pack_documents(spark: SparkSession, sf_dir: str) -> str:
    """Pack the documents into ZIP archives, some hundred each; returns the folder.

    Entries are ``<lang>/<doc_id>.txt``.
    """
    folder = new_shared_path(spark, "archives")
    number = F.expr(f"doc_id div {DOCUMENTS_PER_ARCHIVE}").cast("string")
    rows = table(spark, sf_dir, "documents").select(
        F.concat(F.lit(f"{folder}/docs-"), number, F.lit(".zip")).alias("archive"),
        "doc_id",
        F.col("lang").alias("folder"),
        F.concat(F.col("doc_id").cast("string"), F.lit(".txt")).alias("name"),
        "text",
    )
    packed = (
        rows.repartition("archive")
        .sortWithinPartitions("archive", "doc_id")
        .mapInArrow(zippack.pack_rows, "archive string")
    )
    stage(packed, "packed")
    return folder


def id_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Map with chains, a chain in reverse order, repeated old ids and null new ids."""
    customer = table(spark, sf_dir, "customer").select("c_custkey")
    parts = [
        customer.filter("c_custkey % 10 in (0, 1)").selectExpr(
            "c_custkey as seq", "c_custkey as old_id", "c_custkey + 1 as new_id"
        ),
        customer.filter("c_custkey % 10 in (5, 6)").selectExpr(
            f"{_STEP} - c_custkey as seq", "c_custkey as old_id", "c_custkey + 1 as new_id"
        ),
        customer.filter("c_custkey % 10 in (0, 3)").selectExpr(
            f"{2 * _STEP} + c_custkey as seq", "c_custkey as old_id", "c_custkey + 2 as new_id"
        ),
        customer.filter("c_custkey % 100 = 8").selectExpr(
            f"{3 * _STEP} + c_custkey as seq", "c_custkey as old_id", "cast(null as bigint) as new_id"
        ),
    ]
    united = parts[0]
    for part in parts[1:]:
        united = united.unionByName(part)
    return united


def merge_tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """Trades, daily process, archive and holdings, each keyed by ``guid``."""
    balance = "case when event_id % 7 = 0 then 0.0D when event_id % 11 = 0 then null else value end"
    return {
        "trades": table(spark, sf_dir, "orders").withColumnRenamed("o_custkey", "guid"),
        "daily": table(spark, sf_dir, "events").selectExpr(
            "event_id", "user_id as guid", f"{balance} as balance"
        ),
        "archive": table(spark, sf_dir, "lineitem").withColumnRenamed("l_suppkey", "guid"),
        "holdings": table(spark, sf_dir, "customer").withColumnRenamed("c_custkey", "guid"),
    }


def report_tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """Brokers, accounts, users, customers and daily process for the delivery report."""
    nation, orders = table(spark, sf_dir, "nation"), table(spark, sf_dir, "orders")
    last = orders.groupBy("o_custkey").agg(F.max("o_orderdate").alias("LastProcessed"))
    return {
        "brokers": nation.selectExpr("n_nationkey as PrimaryGUID", "n_name as BrokerName"),
        "accounts": table(spark, sf_dir, "customer")
        .join(last, F.col("c_custkey") == F.col("o_custkey"))
        .selectExpr("c_custkey as AccountGUID", "c_nationkey as ForeignGUID", "LastProcessed"),
        "users": nation.selectExpr("n_nationkey as PrimaryGUID", "n_regionkey as ForeignGUID"),
        "customers": table(spark, sf_dir, "region").selectExpr(
            "r_regionkey as PrimaryGUID", "r_name as CompanyName"
        ),
        "daily": orders.selectExpr("o_custkey as AccountGUID", "o_orderdate as DateOfData"),
    }
