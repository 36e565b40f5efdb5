"""Customer blocks, sections and search on small feeds."""

import zipfile

import pytest

from ledgerline.operators import blocks, search, sections
from ledgerline.plans import files
from ledgerline.sources.archives import entry_runs, zip_entries, zip_lines
from ledgerline.sources.zipstream import line_blocks


def feed(spark, **sources):
    rows = [(s, i, v) for s, made in sources.items() for i, v in enumerate(made, 1)]
    return spark.createDataFrame(rows, "src string, line_no bigint, line string")


def detail(number, account="123456789", first="  Ann   B  ", second="", other=""):
    return f"D10{number}0101" + account + " " * 6 + first.ljust(67) + " " * 23 + second.ljust(
        68
    ) + " " * 23 + other.ljust(68)


def extracted(spark, codes, lines, **options):
    done = files.extract_customers(lines, codes, **options)
    status = {(r["src"], r["code"]): r["status"] for r in done.status.collect()}
    export = sorted(
        (r["src"], r["code"], r["line_no"], r["line"]) for r in done.export.collect()
    )
    return status, export


TITLE = "|".join(blocks.HOLDER_COLUMNS)


def test_outcomes(spark):
    lines = feed(
        spark,
        ok=["CT AB", "CH AB", detail(1), detail(2), detail(3, second="C\tD"), "CT AB", detail(4), "CT AB"],
        nohead=[detail(2), "CT AB"],
        notrail=["CH AB", detail(2), "CT XY"],
        nodetail=["CH AB", detail(1), "CT AB"],
        adjacent=["CH AB", "CT AB"],
        last=["CT AB", "CH AB"],
    )
    status, export = extracted(spark, ["AB"], lines)
    assert {k[0]: v for k, v in status.items()} == {
        "ok": "ok", "nohead": "header_missing", "notrail": "trailer_missing",
        "nodetail": "no_detail", "adjacent": "no_detail", "last": "trailer_missing",
    }
    assert export == [
        ("adjacent", "AB", 0, TITLE),
        ("nodetail", "AB", 0, TITLE),
        ("ok", "AB", 0, TITLE),
        ("ok", "AB", 4, "vendor|123456789|Ann B||"),
        ("ok", "AB", 5, "vendor|123456789|Ann B|C D|"),
    ]


def test_sources_without_lines_are_reported(spark):
    lines = feed(spark, a=["CH AB", "CT AB"])
    sources = spark.createDataFrame([("a",), ("empty",)], "src string")
    status, _ = extracted(spark, ["AB"], lines, sources=sources)
    assert status[("empty", "AB")] == "header_missing"


def test_match_modes(spark):
    lines = feed(
        spark,
        f=["CHABC         x", detail(2, "1" * 9), "CTABC", "CHAB          x", detail(3, "2" * 9), "CTAB"],
    )

    def accounts(code, match):
        done = files.extract_customers(lines, [code], match=match, field=(2, 12))
        return [r["account_number"] for r in done.records.collect()]

    assert accounts("AB", "regex") == ["1" * 9]
    assert accounts("AB", "literal") == ["1" * 9]
    assert accounts("AB", "field") == ["2" * 9]
    assert accounts("A.C", "regex") == ["1" * 9]
    assert accounts("A.C", "literal") == []
    bounds = blocks.block_bounds(lines, None, "field", (2, 12)).collect()
    assert sorted((r["code"], r["start_line"], r["end_line"]) for r in bounds) == [
        ("AB", 4, 6), ("ABC", 1, 3),
    ]
    table = spark.createDataFrame([("ABC",), ("ABC",), ("none",)], "code string")
    done = files.extract_customers(lines, table, match="field", field=(2, 12))
    assert [tuple(r) for r in done.status.collect()] == [("f", "ABC", "ok", 1)]
    with pytest.raises(ValueError):
        blocks.block_bounds(lines, table, "exact")
    with pytest.raises(ValueError):
        blocks.block_bounds(lines, None, "regex")
    with pytest.raises(ValueError):
        blocks.block_bounds(lines, ["AB"], "exact")
    with pytest.raises(ValueError, match="place of the code field"):
        blocks.block_bounds(lines, ["AB"], "field")
    for long in (["ABC", "ABCD"], spark.createDataFrame([("ABCD",)], "code string")):
        with pytest.raises(ValueError, match="longer than the field"):
            blocks.block_bounds(lines, long, "field", (2, 3))


def test_only_the_first_block_counts(spark):
    lines = feed(spark, f=["CH A", detail(2), "CT A", "CH A", detail(3), "CT A"])
    assert files.extract_customer(lines, "A").records.count() == 1


def test_short_lines_and_detail_mark_at_any_position(spark):
    lines = feed(spark, f=["CH A", "xxD1050101", "D1090101 1", "D1010101", "CT A"])
    rows = files.extract_customer(lines, "A").records.orderBy("line_no").collect()
    assert [tuple(r)[2:] for r in rows] == [
        (2, "vendor", "01", "", "", ""), (3, "vendor", " 1", "", "", ""),
    ]


@pytest.mark.parametrize("width", [2, 3, 1 << 20])
@pytest.mark.parametrize("limit", [0, 1 << 20])
def test_blocks_and_sections_do_not_depend_on_bucket_or_join(spark, width, limit):
    spark.conf.set("spark.ledgerline.broadcastBytes", limit)
    spark.conf.set("spark.ledgerline.hotKeyRows", 1)
    try:
        made = ["CH A", *[f"l{i}" for i in range(20)], "CT A", "tail"]
        lines = feed(spark, f=made, g=["CH A", "CT A"], h=["x"])
        staged = blocks.stage_blocks(blocks.block_bounds(lines, ["A"]), width)
        got = blocks.block_lines(lines, staged, width).orderBy("line_no").collect()
        assert [r["line"] for r in got] == made[1:-2]
        split = sections.split_sections(lines, 2, 3, width).collect()
        by = {}
        for r in sorted(split, key=lambda r: r["line_no"]):
            by.setdefault((r["src"], r["section"]), []).append(r["line"])
        assert by[("f", "header")] == made[:2] and by[("f", "trailer")] == made[-3:]
        assert by[("f", "data")] == made[2:-3]
        assert by[("h", "header")] == ["x"] == by[("h", "trailer")]
        assert ("g", "data") not in by and len(by[("g", "trailer")]) == 2
    finally:
        spark.conf.unset("spark.ledgerline.broadcastBytes")
        spark.conf.unset("spark.ledgerline.hotKeyRows")


@pytest.mark.parametrize(
    "header, trailer, expected", [(1, 1, (1, 3, 1)), (0, 0, (0, 5, 0)), (3, 3, (3, 0, 3)), (1, -1, (1, 3, 1)), (9, 0, (5, 0, 0))]
)
def test_section_sizes(spark, header, trailer, expected):
    lines = feed(spark, f=list("abcde"))
    split = [r["section"] for r in sections.split_sections(lines, header, trailer).collect()]
    names = ("header", "data", "trailer")
    assert tuple(split.count(n) for n in names) == expected
    counted = sections.section_counts(lines, header, trailer).first()
    assert tuple(counted[n] for n in names) == expected


def test_negative_header_is_refused(spark):
    with pytest.raises(ValueError):
        sections.split_sections(feed(spark, f=["a"]), -1, 0)


def test_exports_are_quoted_on_demand(spark):
    line = "D1020101" + "1" * 9 + " " * 6 + 'A|n "B"'.ljust(67)
    lines = feed(spark, f=["CH AB", line, "CT AB"])
    for quote, name in ((None, 'A|n "B"'), ('"', '"A|n ""B"""')):
        rows = files.extract_customers(lines, ["AB"], quote=quote).export.collect()
        assert [r["line"] for r in rows if r["line_no"]] == [f"vendor|111111111|{name}||"]


def test_jobs_take_encoding_and_wide_breaks(spark, tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    (folder / "f.txt").write_bytes("h\x0bé\x85t\n".encode("latin-1"))
    options = dict(encoding="ISO-8859-1", unicode_breaks=True)
    counts = files.split_files(spark, "*.txt", str(folder), str(tmp_path / "o"), 1, 1, **options)
    assert [tuple(r) for r in counts.collect()] == [("f.txt", 3, 1, 1, 1)]
    found = files.search_files(spark, "*.txt", str(folder), "É", **options).collect()
    assert [r["line_number"] for r in found] == [2]
    (folder / "f.txt").write_bytes(("CH AB\x0b" + detail(2) + "\x85CT AB\n").encode("latin-1"))
    status = files.extract_customer_files(spark, "*.txt", str(folder), ["AB"], str(tmp_path / "e"), **options)
    assert [tuple(r) for r in status.collect()] == [("f.txt", "AB", "ok", 1)]


def test_file_jobs(spark, tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    (folder / "f1.txt").write_text("\n".join(["CH AB", detail(2), "CT AB"]))
    (folder / "f2.txt").write_text("x")
    (folder / "empty.txt").write_text("")
    status = files.extract_customer_files(spark, "*.txt", str(folder), ["AB"], str(tmp_path / "o1"))
    assert {r["src"]: r["status"] for r in status.collect()} == {
        "f1.txt": "ok", "f2.txt": "header_missing", "empty.txt": "header_missing",
    }
    plan = status._jdf.queryExecution().executedPlan().toString()
    assert "Scan parquet" in plan and "Scan text" not in plan and "BatchScan" not in plan  # the feed is not read again
    out = list((tmp_path / "o1" / "src=f1.txt" / "code=AB").glob("*/part-*"))
    assert "".join(p.read_text() for p in sorted(out)) == f"{TITLE}\nvendor|123456789|Ann B||\n"
    counts = files.split_files(spark, "*.txt", str(folder), str(tmp_path / "o2"), 1, 1)
    assert sorted(tuple(r) for r in counts.collect()) == [
        ("empty.txt", 0, 0, 0, 0), ("f1.txt", 3, 1, 1, 1), ("f2.txt", 1, 1, 0, 1),
    ]
    made = (tmp_path / "o2" / "src=f1.txt" / "section=header").glob("*/part-*")
    assert [p.read_text() for p in made] == ["CH AB\n"]
    from ledgerline.operators.masking import fixed

    audit = files.mask_files(spark, "*.txt", str(folder), [fixed()], str(tmp_path / "o3"))
    assert sorted((r["src"], r["rows"]) for r in audit.collect()) == [("empty.txt", 0), ("f1.txt", 3), ("f2.txt", 1)]
    copies = list((tmp_path / "o3" / "src=f1.txt").glob("block=*/part-*"))
    assert len(copies) == 1 and copies[0].read_text().startswith("CH AB\nD102010" + "9" * 10 + " ")
    found = files.search_files(spark, "*.txt", str(folder), "ann +b")
    assert [(m["matches"][0]["value"], m["line_number"]) for m in found.collect()] == [("Ann   B", 2)]


def test_entries_of_all_kinds_are_read(spark, tmp_path):
    with zipfile.ZipFile(tmp_path / "a.zip", "w") as z:
        z.writestr("ä/ö 1.txt", "packed\n" * 500, zipfile.ZIP_DEFLATED)
        z.writestr("same.txt", "first", zipfile.ZIP_STORED)
        with pytest.warns(UserWarning):
            z.writestr("same.txt", "second", zipfile.ZIP_BZIP2)
        with z.open("big.txt", "w", force_zip64=True) as entry:
            entry.write(b"x\ny")
    with zipfile.ZipFile(tmp_path / "old.zip", "w") as z:
        z.writestr("caf_.txt", "old name")
    raw = (tmp_path / "old.zip").read_bytes().replace(b"caf_", b"caf\x82")
    (tmp_path / "old.zip").write_bytes(raw)
    lines = zip_lines(spark, "*.zip", str(tmp_path)).groupBy("entry_no", "entry").agg({"line": "max", "*": "count"})
    got = sorted(tuple(r) for r in lines.collect())
    assert got == [
        (0, "café.txt", "old name", 1), (0, "ä/ö 1.txt", "packed", 500), (1, "same.txt", "first", 1),
        (2, "same.txt", "second", 1), (3, "big.txt", "y", 2),
    ]


def test_damaged_entries_fail(spark, tmp_path):
    make_zip(tmp_path / "a.zip")
    raw = (tmp_path / "a.zip").read_bytes().replace(b"bar foo", b"bar fxo")
    (tmp_path / "a.zip").write_bytes(raw)
    with pytest.raises(Exception, match="CRC"):
        zip_lines(spark, "*.zip", str(tmp_path)).collect()


def make_zip(path):
    with zipfile.ZipFile(path, "w") as z:
        z.writestr("dir/", "")
        z.writestr("dir/x.txt", "Foo\nbar foo foo\n")
        z.writestr("top.txt", "nothing\r\nFOO")
        z.writestr("empty.txt", "")


def test_zip_search(spark, tmp_path):
    make_zip(tmp_path / "a.zip")
    archive = f"file:{tmp_path}/a.zip"
    found = search.flat_matches(files.search_zip(spark, "*.zip", str(tmp_path), "foo"))
    assert sorted(tuple(r) for r in found.collect()) == [
        ("dir\\x.txt", f"{archive}\\dir", 1, "Foo", 0, 3),
        ("dir\\x.txt", f"{archive}\\dir", 2, "foo", 4, 3),
        ("top.txt", archive, 2, "FOO", 0, 3),
    ]
    none = files.search_zip(spark, "*.none", str(tmp_path), "foo")
    assert none.count() == 0


def test_archives_over_the_content_limit_are_read(spark, tmp_path):
    make_zip(tmp_path / "a.zip")
    spark.conf.set("spark.sql.sources.binaryFile.maxLength", 10)
    try:
        assert zip_entries(spark, "*.zip", str(tmp_path)).count() == 3
        assert zip_lines(spark, "*.zip", str(tmp_path)).count() == 4
    finally:
        spark.conf.unset("spark.sql.sources.binaryFile.maxLength")


def test_archives_are_read_in_runs(spark, tmp_path):
    """A run is opened once: tasks and archives meet about as often as the bytes ask for."""
    from pyspark.sql import functions as F

    for a in range(4):
        with zipfile.ZipFile(tmp_path / f"hot{a}.zip", "w") as z:
            for i in range(200):
                z.writestr(f"{i}.txt", f"line of {i}\n" * 50)
    total = sum(f.stat().st_size for f in tmp_path.iterdir())
    spark.conf.set("spark.ledgerline.archiveTaskBytes", 20_000)
    try:
        runs = entry_runs(spark, "*.zip", str(tmp_path))
        pairs = runs.select("archive", F.spark_partition_id().alias("p")).distinct()
        assert 20 < pairs.count() <= total // 20_000 + 8
        lines = zip_lines(spark, "*.zip", str(tmp_path))
        assert lines.select(F.spark_partition_id().alias("p")).distinct().count() > 8
        assert lines.count() == 40_000
    finally:
        spark.conf.unset("spark.ledgerline.archiveTaskBytes")


def test_wide_directory_and_other_methods(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(zipfile, "ZIP64_LIMIT", 4)
    monkeypatch.setattr(zipfile, "ZIP_FILECOUNT_LIMIT", 2)
    for method in (zipfile.ZIP_STORED, zipfile.ZIP_DEFLATED, zipfile.ZIP_BZIP2):
        with zipfile.ZipFile(tmp_path / f"m{method}.zip", "w", method) as z:
            for i in range(5):
                with z.open(f"{i}.txt", "w", force_zip64=True) as f:
                    f.write(f"{i}\n".encode() * 90_000)
            z.comment = b"PK\x05\x06 not the end"
    found = zip_lines(spark, "*.zip", str(tmp_path)).groupBy("archive", "entry").count().collect()
    assert len(found) == 15 and {r["count"] for r in found} == {90_000}


@pytest.mark.parametrize("chunk", [1, 2, 3, 7, 1 << 20])
@pytest.mark.parametrize(
    "data", [b"", b"\n", b"a", b"a\r\nb", b"a\rb\r", b"\r\n\r\n", b"\xef\xbb\xbfx\ny", b"a\r\r\nb\n\nc", "é\n😀".encode()]
)
def test_stream_lines_equal_splitlines(chunk, data):
    import io

    got = [line for block in line_blocks(io.BytesIO(data), chunk) for line in block]
    assert got == data.removeprefix(b"\xef\xbb\xbf").splitlines()


@pytest.mark.parametrize("chunk", [1, 2, 5, 1 << 20])
@pytest.mark.parametrize("encoding", ["utf-16", "utf-16-be"])
def test_wide_text_with_a_byte_order_mark(chunk, encoding):
    import io

    text = "é1\r\n\n😀\rend"
    data = (b"\xfe\xff" if encoding == "utf-16-be" else b"") + text.encode(encoding)
    got = [line.decode() for block in line_blocks(io.BytesIO(data), chunk) for line in block]
    assert got == text.splitlines()


def test_lines_that_are_not_utf8(spark, tmp_path):
    with zipfile.ZipFile(tmp_path / "a.zip", "w") as z:
        z.writestr("x.txt", b"ok\n\xff\xe9x\nafter")
        z.writestr("w.txt", "wide\nfoo".encode("utf-16"))
    got = {(r["entry"], r["line_no"]): r["line"] for r in zip_lines(spark, "*.zip", str(tmp_path)).collect()}
    assert got == {
        ("x.txt", 1): "ok", ("x.txt", 2): "\ufffd\ufffdx", ("x.txt", 3): "after",
        ("w.txt", 1): "wide", ("w.txt", 2): "foo",
    }
