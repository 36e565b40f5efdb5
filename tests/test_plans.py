"""Plans must stay fit for large data: what is scanned, moved and broadcast."""

import datetime as dt
import re

import pytest
from pyspark.sql import functions as F

from ledgerline import fixtures as fx
from ledgerline.operators import blocks, idmap, masking, merging, search, sections
from ledgerline.plans.deliveries import exceptions_report
from ledgerline.sources.lines import (
    explode_lines,
    read_counted_lines,
    read_lines,
    read_numbered_lines,
)
from ledgerline.sinks.text import read_written_lines
from ledgerline.streaming.masking import mask_stream, stream_lines

SF = "/root/testdata/sf0.001"


def plan(frame):
    return frame._jdf.queryExecution().explainString(
        frame.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    )


@pytest.fixture()
def folder(tmp_path):
    for name in "ab":
        made = ["CH A", *[f"{name}{i}" for i in range(50)], "CT A"]
        (tmp_path / f"{name}.txt").write_text("\n".join(made))
    return str(tmp_path)


def test_masking_is_one_pass_without_shuffle(spark, folder):
    text = plan(masking.mask_delimited(read_lines(spark, "*", folder), "|"))
    assert "Exchange" not in text and text.count("Scan text") == 2  # tree and details


def test_lines_are_numbered_without_moving_them(spark, folder):
    text = plan(read_numbered_lines(spark, "*", folder))
    assert "BroadcastHashJoin" in text and "Exchange hashpartitioning" not in text
    assert "NestedLoop" not in text and "SinglePartition" not in text


def test_search_filters_before_numbering(spark, folder):
    found = search.search_lines(read_numbered_lines(spark, "*", folder), "a1+")
    tree = plan(found).split("\n\n")[0]
    assert tree.index("BroadcastHashJoin") < tree.index("Filter")
    assert found.count() == 11


def test_blocks_and_sections_use_equi_joins(spark, folder):
    lines = read_numbered_lines(spark, "*", folder)
    staged = blocks.stage_blocks(blocks.block_bounds(lines, ["A"]))
    for frame in (blocks.block_lines(lines, staged), sections.split_sections(lines, 1, 1)):
        text = plan(frame)
        assert "NestedLoop" not in text and "Cartesian" not in text
        assert "SinglePartition" not in text and "SortMergeJoin" not in text


def test_sections_of_files_need_no_join_on_the_source(spark, folder):
    sized = read_counted_lines(spark, "*", folder).sized
    split = sections.split_sections(sized, 2, 1)
    assert plan(split).split("\n\n")[0].count("Join") == 1  # that of the numbers
    got = {(r["section"], r["count"]) for r in split.groupBy("section").count().collect()}
    assert got == {("header", 4), ("data", 98), ("trailer", 2)}


def test_large_ranges_are_joined_on_source_and_bucket(spark, folder):
    lines = read_numbered_lines(spark, "*", folder)
    spark.conf.set("spark.ledgerline.broadcastBytes", "0")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        staged = blocks.stage_blocks(blocks.block_bounds(lines, ["A"]))
        frame = blocks.block_lines(lines, staged)
        text = plan(frame)
        assert re.search(r"hashpartitioning\(src#\d+, __bucket#", text)
        assert frame.count() == 100
    finally:
        spark.conf.unset("spark.ledgerline.broadcastBytes")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_little_data_of_many_tasks_is_written_to_few_files(spark):
    from ledgerline.scale import stage

    many = spark.range(0, 1000, 1, 60).selectExpr("id", "concat('x', id) as x")
    staged = stage(many, "gathered", gather=True, top=F.max("id"))
    assert (staged.rows, staged.metrics["top"]) == (1000, 999)
    files = {r[0] for r in staged.df.select("_metadata.file_path").distinct().collect()}
    assert len(files) == 1
    assert staged.df.agg(F.sum("id")).first()[0] == 499500


def test_texts_are_split_once(spark):
    text = plan(explode_lines(fx.table(spark, SF, "documents"), "doc_id", "text"))
    assert "ReadSchema: struct<doc_id:bigint,text:string>" in text
    assert "Filter" not in text.split("\n\n")[0]


def test_report_pushes_dates_and_prunes_columns(spark):
    tables = fx.report_tables(spark, SF)
    names = [tables[n] for n in ("brokers", "accounts", "users", "customers")]
    text = plan(exceptions_report(*names, tables["daily"], fx.AS_OF, fx.LOOKBACK_DAYS))
    assert "PushedFilters: [In(o_orderdate" in text
    assert "o_totalprice" not in text and "Cartesian" not in text and "NestedLoop" not in text
    by_day = plan(
        exceptions_report(*names, tables["daily"], fx.AS_OF, fx.LOOKBACK_DAYS, by_day=True)
    )
    assert "GreaterThanOrEqual(o_orderdate,2001-07-23T00:00)" in by_day


def test_small_map_is_broadcast_and_audit_reads_keys_only(spark):
    resolved = idmap.resolve_id_map(fx.id_map(spark, SF))
    trades = merging.match(fx.merge_tables(spark, SF)["trades"], resolved, "guid")
    assert "Exchange hashpartitioning" not in plan(merging.repoint(trades))
    counted = plan(merging.audit(trades, "trades", "repoint"))
    assert "ReadSchema: struct<o_custkey:bigint>" in counted


def test_streamed_masking_handles_each_file_once(spark, tmp_path):
    inbox, out, state = (str(tmp_path / n) for n in ("in", "out", "state"))
    (tmp_path / "in").mkdir()

    def run():
        lines = stream_lines(spark, inbox, names="name")
        writer = mask_stream(lines, [masking.fixed([(0, 1)], src_pattern="^my feed|^b")], out, state)
        writer.trigger(availableNow=True).start().awaitTermination()
        rows = read_written_lines(spark, out).collect()
        return sorted((r["src"], r["line_no"], r["line"]) for r in rows)

    (tmp_path / "in" / "my feed.txt").write_text("abc\n12\n" + "z\n" * 50 + "y")
    first = [("my feed.txt", 1, "XXc"), ("my feed.txt", 2, "99")] + [("my feed.txt", i, "X") for i in range(3, 54)]
    assert run() == first
    (tmp_path / "in" / "b.txt").write_text("q")
    assert run() == [("b.txt", 1, "X"), *first]
    assert run() == [("b.txt", 1, "X"), *first]


def test_the_report_holds_no_arrays_of_rows(spark):
    tables = fx.report_tables(spark, SF)
    names = [tables[n] for n in ("brokers", "accounts", "users", "customers")]
    text = plan(exceptions_report(*names, tables["daily"], fx.AS_OF, fx.LOOKBACK_DAYS))
    assert "ObjectHashAggregate" not in text and "SortAggregate" not in text


def test_dates_are_values(spark):
    from ledgerline.functions.dates import business_date_list

    assert business_date_list(spark, dt.date(2001, 7, 28), 7)[0] == dt.date(2001, 7, 23)


class FakeSession:
    """Just enough of a session to ask for the shared folder."""

    def __init__(self, master, setting=None):
        self.conf = self.sparkContext = self
        self.master, self.setting, self.folder = master, setting, None

    def get(self, name, default):
        return self.setting if name == "spark.checkpoint.dir" else default

    def getCheckpointDir(self):
        return self.folder

    def setCheckpointDir(self, folder):
        self.folder = folder


def test_shared_folder_is_the_configured_one_and_never_a_local_one_on_a_cluster():
    from ledgerline.scale import shared_dir

    assert shared_dir(FakeSession("spark://host", "hdfs://x/check/")) == "hdfs://x/check"
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        shared_dir(FakeSession("spark://host"))
    local = FakeSession("local[2]")
    assert shared_dir(local) == shared_dir(local) == local.folder
