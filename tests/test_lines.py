"""Reading and writing of lines."""

import os
import random
import re

import pytest
from pyspark.sql import functions as F

from ledgerline.sinks.text import read_written_lines, write_lines, write_scanned_lines
from ledgerline.sources.lines import (
    explode_lines,
    list_files,
    number_rows,
    read_counted_lines,
    read_lines,
    read_numbered_lines,
    source_path,
)


@pytest.fixture()
def settings(spark):
    """Set options for one test."""
    before = {}

    def put(name, value):
        before.setdefault(name, spark.conf.get(name, None))
        spark.conf.set(name, str(value))

    yield put
    for name, value in before.items():
        spark.conf.unset(name) if value is None else spark.conf.set(name, value)


def write(folder, **texts):
    for name, text in texts.items():
        (folder / f"{name}.txt").write_bytes(text.encode() if isinstance(text, str) else text)


def numbered(frame):
    return sorted((r["src"], r["line_no"], r["line"]) for r in frame.collect())


@pytest.mark.parametrize("split_bytes", [1 << 12, 1 << 14, 128 << 20])
@pytest.mark.parametrize("end", ["\n", "\r\n", "\r"])
@pytest.mark.parametrize("broadcast", [True, False])
def test_numbers_do_not_depend_on_splits(spark, settings, tmp_path, split_bytes, end, broadcast):
    settings("spark.sql.files.maxPartitionBytes", split_bytes)
    settings("spark.sql.files.openCostInBytes", 1 << 10)
    if not broadcast:
        settings("spark.ledgerline.broadcastBytes", 0)
        settings("spark.sql.autoBroadcastJoinThreshold", -1)
    rng = random.Random(7)
    expected = []
    for name, count in (("big", 4000), ("mid", 700), ("one", 1), ("empty", 0)):
        made = [f"{i}:" + "x" * rng.randrange(60) for i in range(1, count + 1)]
        write(tmp_path, **{name: end.join(made)})
        expected += [(f"{name}.txt", i, v) for i, v in enumerate(made, 1)]
    frame = read_numbered_lines(spark, "*.txt", str(tmp_path), names="name")
    if split_bytes == 1 << 12:
        assert read_lines(spark, "*.txt", str(tmp_path)).rdd.getNumPartitions() > 8
    assert numbered(frame) == sorted(expected)
    assert numbered(frame.filter("line like '17%'")) == sorted(
        e for e in expected if e[2].startswith("17")
    )


def test_changed_settings_do_not_move_numbers(spark, settings, tmp_path):
    for name in "abc":
        write(tmp_path, **{name: "\n".join(f"{i} fail" if i % 7 == 0 else f"{i}" for i in range(1, 601))})
    settings("spark.sql.files.openCostInBytes", 1)
    settings("spark.sql.files.maxPartitionBytes", 3600)
    frame = read_numbered_lines(spark, "*.txt", str(tmp_path))
    for split_bytes in (5500, 1 << 20, 700):
        settings("spark.sql.files.maxPartitionBytes", split_bytes)
        settings("spark.sql.files.openCostInBytes", split_bytes)
        found = frame.filter("line like '%fail'").collect()
        assert len(found) == 255 and all(r["line"].split()[0] == str(r["line_no"]) for r in found)
        assert all(r["line"].split()[0] == str(r["line_no"]) for r in frame.filter("line like '%fail'").limit(5).collect())
        assert frame.agg(F.sum("line_no")).first()[0] == 3 * 600 * 601 // 2


def test_reading_leaves_no_setting_behind(spark, tmp_path):
    write(tmp_path, a="x")
    before = spark.conf.getAll
    read_numbered_lines(spark, "*.txt", str(tmp_path)).collect()
    assert spark.conf.getAll == before


def test_files_without_content_and_hidden_names(spark, tmp_path):
    write(tmp_path, a="x\ny", empty="")
    write(tmp_path, **{".hidden": "h"})
    listed = {r["name"]: r["bytes"] for r in list_files(spark, "*.txt", str(tmp_path)).collect()}
    assert listed == {"a.txt": 3, "empty.txt": 0}
    counts = read_counted_lines(spark, "*.txt", str(tmp_path), names="name").counts
    assert {r["src"]: r["lines"] for r in counts.collect()} == {"a.txt": 2, "empty.txt": 0}
    names = read_counted_lines(spark, "*.txt", str(tmp_path), names="path").counts
    assert len({r["src"].rpartition("/")[0] for r in names.collect()}) == 1
    write(tmp_path, _feed="u")
    assert sorted(r["src"] for r in read_lines(spark, "*.txt", str(tmp_path), names="name").collect()) == [
        "_feed.txt", "a.txt", "a.txt",
    ]
    assert read_lines(spark, "a*", str(tmp_path)).count() == 2
    assert numbered(read_numbered_lines(spark, ".*", str(tmp_path), names="name")) == [(".hidden.txt", 1, "h")]
    every = read_counted_lines(spark, "*", str(tmp_path), names="name", hidden=True)
    assert {r["src"]: r["lines"] for r in every.counts.collect()} == {
        ".hidden.txt": 1, "_feed.txt": 1, "a.txt": 2, "empty.txt": 0,
    }
    assert len(numbered(every.lines)) == 4
    only = tmp_path / "only"
    only.mkdir()
    write(only, empty="")
    read = read_counted_lines(spark, "*.txt", str(only), names="name")
    assert read.lines.count() == 0 and [tuple(r) for r in read.counts.collect()] == [("empty.txt", 0)]


def test_folders_beside_the_files_are_left_alone(spark, tmp_path):
    write(tmp_path, **{"a [1]": "x\ny"})
    for sub in ("out/src=a/block=1", "out/src=b", "k=1"):
        folder = tmp_path / sub
        folder.mkdir(parents=True)
        write(folder, z="no")
    assert numbered(read_numbered_lines(spark, "*.txt", str(tmp_path), names="name")) == [
        ("a [1].txt", 1, "x"), ("a [1].txt", 2, "y"),
    ]


def test_line_breaks(spark, tmp_path):
    value = "a\x0bb\x0cc\u2028d\x85e\rf\ng\r\nh"
    write(tmp_path, a=value, b="x\x1cy\n\nz\x0b\nlast")
    plain = numbered(read_numbered_lines(spark, "a.txt", str(tmp_path), names="name"))
    assert [r[2] for r in plain] == ["a\x0bb\x0cc\u2028d\x85e", "f", "g", "h"]
    wide = read_numbered_lines(spark, "*.txt", str(tmp_path), names="name", unicode_breaks=True)
    expected = [("a.txt", i, v) for i, v in enumerate(value.splitlines(), 1)]
    expected += [
        ("b.txt", i, v) for i, v in enumerate("x\x1cy\n\nz\x0b\nlast".splitlines(), 1)
    ]
    assert numbered(wide) == sorted(expected)


def test_wide_breaks_over_many_splits(spark, settings, tmp_path):
    settings("spark.sql.files.maxPartitionBytes", 1 << 11)
    settings("spark.sql.files.openCostInBytes", 1)
    text = "\n".join(f"{i}\x0b{i}b" for i in range(1500))
    write(tmp_path, a=text)
    wide = read_numbered_lines(spark, "*.txt", str(tmp_path), names="name", unicode_breaks=True)
    assert numbered(wide) == sorted(
        ("a.txt", i, v) for i, v in enumerate(text.splitlines(), 1)
    )


def test_packed_files(spark, tmp_path):
    import gzip

    with gzip.open(tmp_path / "a.txt.gz", "wt") as f:
        f.write("\n".join(str(i) for i in range(5000)))
    got = numbered(read_numbered_lines(spark, "*.gz", str(tmp_path), names="name"))
    assert got == sorted(("a.txt.gz", i + 1, str(i)) for i in range(5000))


def test_encoding(spark, tmp_path):
    write(tmp_path, a="é\nü".encode("latin-1"))
    frame = read_numbered_lines(spark, "*.txt", str(tmp_path), encoding="ISO-8859-1")
    assert [r[2] for r in numbered(frame)] == ["é", "ü"]


@pytest.mark.parametrize("split_bytes", [64, 128 << 20])
@pytest.mark.parametrize("encoding", ["utf-16", "utf-16-le", "utf-16-be", "utf-32", "UTF-32BE"])
def test_wide_encodings(spark, settings, tmp_path, split_bytes, encoding):
    settings("spark.sql.files.maxPartitionBytes", split_bytes)
    settings("spark.sql.files.openCostInBytes", 1)
    made = {"a": "é\nü\r\n\n日本\r𝄞 x\u0a0a\u0d0d\n", "b": "\n".join(str(i) * (i % 30) for i in range(200)), "c": "\n"}
    write(tmp_path, **{n: t.encode(encoding) for n, t in made.items()})
    frame = read_numbered_lines(spark, "*.txt", str(tmp_path), encoding=encoding, names="name")
    wanted = [(f"{n}.txt", i, v) for n, t in made.items() for i, v in enumerate(re.split("\r\n|\n|\r", t.removesuffix("\n")), 1)]
    assert numbered(frame) == sorted(wanted)
    lines = read_lines(spark, "*.txt", str(tmp_path), encoding=encoding, names="name")
    assert sorted((r["src"], r["line"]) for r in lines.collect()) == sorted((n, v) for n, _, v in wanted)


@pytest.mark.parametrize("split_bytes", [4, 36, 1000])
def test_byte_ranges_share_and_lose_no_line(spark, settings, tmp_path, split_bytes):
    """Every kind of line end at every place of a range, lines longer than ranges, and no end at the end."""
    settings("spark.sql.files.maxPartitionBytes", split_bytes)
    settings("spark.sql.files.openCostInBytes", 1)
    rng = random.Random(split_bytes)
    ends = ["\n", "\r", "\r\n", "\x0b", "\x0c", "\x1c", "\x85", "\u2028", "\u2029", "\r\r\n"]
    texts = {}
    for i in range(12):
        size = 40 if split_bytes == 4 else 150
        text = "".join("x€é"[rng.randrange(3)] * rng.choice([0, 1, 2, 9, 60]) + rng.choice(ends) for _ in range(rng.randint(1, size // 3)))
        texts[f"f{i}"] = text + rng.choice(["", "last", "\x0b", "\r"])
    texts["g"] = "abc\x0b"
    write(tmp_path, **texts)
    frame = read_numbered_lines(spark, "*.txt", str(tmp_path), names="name", unicode_breaks=True)
    wanted = [(f"{n}.txt", i, v) for n, t in texts.items() for i, v in enumerate(t.splitlines(), 1)]
    assert numbered(frame) == sorted(wanted)
    counts = read_counted_lines(spark, "*.txt", str(tmp_path), names="name", unicode_breaks=True)
    assert {r["src"]: r["lines"] for r in counts.counts.collect()} == {f"{n}.txt": len(t.splitlines()) for n, t in texts.items()}


def test_hidden_folders_are_listed_and_read(spark, tmp_path):
    for sub in ("_x", ".x", "y", "y/_z"):
        os.makedirs(tmp_path / sub, exist_ok=True)
        write(tmp_path / sub, a=f"in {sub}\n")
    for options in ({}, {"names": "relative"}):
        lines = read_lines(spark, "*.txt", str(tmp_path), recursive=True, **options)
        assert sorted(r["line"] for r in lines.collect()) == ["in .x", "in _x", "in y", "in y/_z"]
    assert list_files(spark, "*.txt", str(tmp_path), recursive=True).count() == 4
    found = read_counted_lines(spark, "*/*.txt", str(tmp_path), names="relative")
    assert sorted((r["src"].split("/")[-2], r["lines"]) for r in found.counts.collect()) == [("_x", 1), ("y", 1)]
    sizes = list_files(spark, "*/*.txt", str(tmp_path), hidden=True).collect()
    assert sorted(r["bytes"] for r in sizes) == [5, 6, 6]


def test_packed_and_marked_files_by_ranges(spark, settings, tmp_path):
    import bz2
    import gzip

    settings("spark.sql.files.maxPartitionBytes", 16)
    text = "\n".join(f"{i}\x0b" for i in range(300))
    (tmp_path / "a.gz").write_bytes(gzip.compress(text.encode()))
    (tmp_path / "b.bz2").write_bytes(bz2.compress(text.encode()))
    (tmp_path / "_c.txt").write_bytes(b"\xef\xbb\xbffirst\nbad \xff byte")
    wide = read_numbered_lines(spark, "?.*2", str(tmp_path), names="name", unicode_breaks=True)
    packed = read_numbered_lines(spark, "*.gz", str(tmp_path), names="name", unicode_breaks=True)
    for name, frame in (("b.bz2", wide), ("a.gz", packed)):
        assert numbered(frame) == sorted((name, i, v) for i, v in enumerate(text.splitlines(), 1))
    odd = read_numbered_lines(spark, "_*", str(tmp_path), names="name").selectExpr("line_no", "hex(line) h").collect()
    assert sorted((r[0], bytes.fromhex(r[1])) for r in odd) == [(1, b"first"), (2, b"bad \xff byte")]


def test_masks_and_paths(spark, tmp_path):
    assert source_path("*.txt", "C:\\data\\in\\") == "C:/data/in/*.txt"
    assert source_path("{a}*", "/d") == "/d/\\{a\\}*"
    write(tmp_path, **{"a1": "x", "a2": "y", "b1": "z", "{a}": "w", "p+q r%41": "v"})
    os.mkdir(tmp_path / "sub")
    write(tmp_path / "sub", a3="deep")

    def found(mask, **options):
        lines = read_lines(spark, mask, str(tmp_path), names="name", **options)
        return sorted((r["src"], r["line"]) for r in lines.collect())

    assert found("a*.txt") == [("a1.txt", "x"), ("a2.txt", "y")]
    assert found("a[!1].txt") == [("a2.txt", "y")]
    assert found("?1.txt") == [("a1.txt", "x"), ("b1.txt", "z")]
    assert found("{a}.txt") == [("{a}.txt", "w")]
    assert found("p*") == [("p+q r%41.txt", "v")]
    assert found("none*") == []
    assert numbered(read_numbered_lines(spark, "none*", str(tmp_path))) == []
    assert list_files(spark, "none*", str(tmp_path)).count() == 0
    assert len(found("*")) == 5  # the sub-folder matches but is not entered
    assert len(found("*", recursive=True)) == 6
    assert found("a[13].txt", recursive=True) == [("a1.txt", "x"), ("a3.txt", "deep")]
    assert found("sub/*.txt") == [("a3.txt", "deep")]
    assert read_lines(spark, "*", str(tmp_path / "nowhere")).count() == 0
    listed = list_files(spark, "a*.txt", str(tmp_path)).collect()
    assert sorted((r["name"], r["bytes"]) for r in listed) == [("a1.txt", 1), ("a2.txt", 1)]


def test_equal_names_in_two_folders_are_numbered_apart(spark, tmp_path):
    for sub in ("x", "y"):
        os.mkdir(tmp_path / sub)
        write(tmp_path / sub, a="1\n2\n3")
    frame = read_numbered_lines(spark, "*", str(tmp_path), names="name", recursive=True)
    assert sorted(r["line_no"] for r in frame.collect()) == [1, 1, 2, 2, 3, 3]


def test_relative_names_tell_files_of_subfolders_apart(spark, tmp_path):
    top = tmp_path / "t p" / "t p"
    for sub in ("x", "y"):
        os.makedirs(top / sub)
        write(top / sub, a="1\n2")
    write(top, a="3")
    for given in (str(top), f"{top}\\", f"file:{top}"):
        frame = read_numbered_lines(spark, "*", given, names="relative", recursive=True)
        assert numbered(frame) == [
            ("a.txt", 1, "3"), ("x/a.txt", 1, "1"), ("x/a.txt", 2, "2"),
            ("y/a.txt", 1, "1"), ("y/a.txt", 2, "2"),
        ]
    write_scanned_lines(
        read_lines(spark, "*", str(top), names="relative", recursive=True), str(tmp_path / "out")
    )
    assert numbered(read_written_lines(spark, str(tmp_path / "out"))) == numbered(frame)
    with pytest.raises(ValueError):
        read_lines(spark, "*", str(top), names="short")


def test_lines_of_a_column(spark):
    table = spark.createDataFrame([(1, "a\nb\n"), (2, ""), (3, None), (4, "x\r\n\r\ny")], "id int, t string")
    assert numbered(explode_lines(table, "id", "t")) == [
        ("1", 1, "a"), ("1", 2, "b"), ("4", 1, "x"), ("4", 2, ""), ("4", 3, "y"),
    ]


def test_number_rows_equals_one_window(spark):
    rows = spark.range(5000).selectExpr(
        "if(id % 3 = 0, 'hot', cast(id % 7 as string)) src", "id * 17 % 5000 as o"
    )
    got = number_rows(rows, "src", ["o"], F.floor(F.col("o") / 100))
    plain = rows.selectExpr(
        "src", "o", "cast(row_number() over (partition by src order by o) as bigint) line_no"
    )
    assert got.select("src", "o", "line_no").exceptAll(plain).count() == 0
    assert got.count() == 5000


@pytest.mark.parametrize("parts", [1, 8])
def test_written_lines_come_back_in_order(spark, tmp_path, parts):
    lines = spark.range(20000).selectExpr(
        "if(id % 3 = 0, 'a/b c=%', concat('s', id % 5)) src", "id * 7919 % 20000 line_no",
        "concat('l', id * 7919 % 20000) line",
    )
    write_lines(lines.repartition(parts), str(tmp_path / "out"), width=3000)
    back = read_written_lines(spark, str(tmp_path / "out"))
    expected = lines.selectExpr(
        "src", "cast(row_number() over (partition by src order by line_no) as bigint) line_no", "line"
    )
    assert back.exceptAll(expected).count() == 0 and back.count() == 20000
    folder = tmp_path / "out" / "src=s1"
    joined = "".join(p.read_text() for p in sorted(folder.glob("*/part-*")))
    wanted = [r["line"] for r in expected.filter("src = 's1'").orderBy("line_no").collect()]
    assert joined.splitlines() == wanted


def test_scanned_lines_are_copied_without_shuffle_and_in_order(spark, settings, tmp_path):
    settings("spark.sql.files.maxPartitionBytes", 1 << 12)
    settings("spark.sql.files.openCostInBytes", 1)
    os.mkdir(tmp_path / "in")
    write(tmp_path / "in", a="\n".join(str(i) for i in range(9000)), b="x\ny")
    lines = read_lines(spark, "*", str(tmp_path / "in"), names="name")
    write_scanned_lines(lines, str(tmp_path / "out"))
    back = read_written_lines(spark, str(tmp_path / "out"))
    expected = [("a.txt", i + 1, str(i)) for i in range(9000)]
    assert numbered(back) == sorted([*expected, ("b.txt", 1, "x"), ("b.txt", 2, "y")])
    plan = lines._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan


def test_many_files_are_read_by_ranges(spark, tmp_path, monkeypatch):
    from ledgerline.sources import lines as module

    for i in range(12):
        start = "﻿" if i == 5 else ""
        (tmp_path / f"{'_' * (i % 3 == 1)}f{i}.txt").write_bytes((start + "é a\r\n\rb\n" * i + "end" * (i % 2)).encode())
    (tmp_path / "bad.txt").write_bytes(b"a\xffb\nc")

    def seen():
        numbered = read_counted_lines(spark, "*.txt", str(tmp_path), names="name")
        plain = read_lines(spark, "*.txt", str(tmp_path), names="name").selectExpr("src", "block", "hex(line)")
        return [sorted(map(tuple, d.collect())) for d in (numbered.lines.selectExpr("src", "line_no", "hex(line)"), numbered.counts, plain)]

    scanned = seen()
    monkeypatch.setattr(module, "SCANNED_FILES", 3)
    monkeypatch.setattr(module, "matching_files", None)  # the scan is not asked
    assert seen() == scanned and len(scanned[0]) > 100


def test_small_files_are_handled_a_few_at_a_time(tmp_path):
    import pyarrow as pa

    from ledgerline.sources import rangeread, zippack

    n = rangeread.LISTED_ROWS + 5
    rows = pa.RecordBatch.from_pydict({"file": [f"{tmp_path}/d/{i}.txt" for i in range(n)], "text": [f"x\n{i}" for i in range(n)]})
    assert max(b.num_rows for b in zippack.write_rows([rows])) <= zippack.SLICE_ROWS
    folder = pa.RecordBatch.from_pydict({"path": [f"{tmp_path}/d"], "odd": [False]})
    listed = list(rangeread.folder_rows([folder], ".*", True, "none", False))
    assert [b.num_rows for b in listed] == [rangeread.LISTED_ROWS, 5]
    asked = [{"src": r["name"], "f": r["path"], "bytes": r["bytes"], "packed": False, "start": 0, "end": r["bytes"]} for b in listed for r in b.to_pylist()]
    lines = list(rangeread.line_rows([pa.RecordBatch.from_pylist(asked)], "UTF-8", True, False))
    assert len(lines) < 10 and sum(b.num_rows for b in lines) == 2 * n
    assert {(r["src"], r["pos"], r["line"]) for b in lines for r in b.to_pylist()} == {x for i in range(n) for x in ((f"{i}.txt", 0, "x"), (f"{i}.txt", 1, str(i)))}
