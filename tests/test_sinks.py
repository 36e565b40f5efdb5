"""Files under names of their own, versions of two writers, and layouts and codes as tables."""

import random

import pytest
from pyspark.sql import functions as F

from ledgerline.operators import blocks, masking
from ledgerline.operators.layouts import audit_by_table, mask_by_table
from ledgerline.plans import files
from ledgerline.sinks.versions import VersionConflict, new_version, read_version, write_version

LAYOUTS = (
    "seq long, src_pattern string, kind string, ranges array<struct<first: int, last: int>>, delimiter string, "
    "columns array<int>, row_prefix string"
)


def masked(text):
    return "".join("X" if c.isascii() and c.isalpha() else "9" if c.isdigit() else c for c in text)


def test_named_files_are_equal_to_the_byte(spark, tmp_path):
    """25 files, some in folders or with hidden names, 5 of them empty, with and without a last line end."""
    rng = random.Random(1)
    texts = {}
    for i in range(20):
        made = [f"line{rng.randrange(10**9)} " + "é" * rng.randrange(30) for _ in range(rng.choice([1, 2, 3, 400]))]
        folder = ["", "sub/", "_x/"][i % 3]
        texts[f"{folder}{['', '.', '_'][i % 3]}f{i}.txt"] = "\n".join(made) + rng.choice(["", "\n", "\n\n"])
    texts |= {f"e{i}.txt": "" for i in range(5)}
    for name, text in texts.items():
        path = tmp_path / "in" / name
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_text(text)
    spark.conf.set("spark.sql.files.maxPartitionBytes", 4096)
    try:
        audit = files.mask_files(
            spark, "*", str(tmp_path / "in"), [masking.fixed([(0, 5)])], str(tmp_path / "copies"), recursive=True, named=True
        )
        files.split_files(
            spark, "*", str(tmp_path / "in"), str(tmp_path / "parts"), 2, 1, recursive=True, hidden=True, named=True
        )
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert {r["src"]: r["rows"] for r in audit.collect()} == {n: len(t.splitlines()) for n, t in texts.items()}
    found = {str(p.relative_to(tmp_path / "copies")): p.read_text() for p in (tmp_path / "copies").rglob("*") if p.is_file() and not p.name.endswith(".crc")}
    wanted = {}
    for name, text in texts.items():
        folder, _, base = name.rpartition("/")
        copy = "".join(masked(x[:6]) + x[6:] for x in text.splitlines(keepends=True))
        wanted[f"{folder}/m_{base}" if folder else f"m_{base}"] = copy
    assert found == wanted
    parts = {str(p.relative_to(tmp_path / "parts")): p.read_text() for p in (tmp_path / "parts").rglob("*") if p.is_file() and not p.name.endswith(".crc")}
    wanted = {}
    for name, text in texts.items():
        lines = text.splitlines()
        cut = {"header": lines[:2], "trailer": lines[-1:], "data": lines[2 : max(2, len(lines) - 1)]}
        wanted |= {f"{name}.{k}.txt": "\n".join(v) for k, v in cut.items()}
    assert parts == wanted


def test_named_exports(spark, tmp_path):
    (tmp_path / "f.txt").write_text("CH AB\nD1020101" + "7" * 9 + "\nCT AB\nCH C\nCT C\n")
    (tmp_path / "g.txt").write_text("x")
    out = tmp_path / "out"
    status = files.extract_customer_files(spark, "*.txt", str(tmp_path), ["AB", "C", "Z"], str(out), named=True)
    assert {(r["src"], r["code"]): r["status"] for r in status.collect()}[("f.txt", "C")] == "no_detail"
    made = {p.name: p.read_text() for p in out.iterdir() if not p.name.endswith(".crc")}
    title = "|".join(blocks.HOLDER_COLUMNS) + "\n"
    assert made == {"f.txt.AB.txt": title + "vendor|777777777|||\n", "f.txt.C.txt": title}
    with pytest.raises(Exception, match="no name"):
        files.extract_customer_files(spark, "f.txt", str(tmp_path), ["A[B/]"], str(tmp_path / "o2"), named=True)


def test_of_two_writers_one_publishes(spark, tmp_path):
    out = str(tmp_path / "v")
    first, second = new_version(spark, out), new_version(spark, out)
    write_version({"t": spark.range(1), "u": spark.range(5)}, out, second)
    with pytest.raises(VersionConflict):
        write_version({"t": spark.range(2), "u": spark.range(6)}, out, first)
    seen = read_version(spark, out)
    assert {k: v.count() for k, v in seen.items()} == {"t": 1, "u": 5}
    third = write_version({"t": spark.range(3)}, out)
    assert third.startswith("00000002-") and read_version(spark, out)["t"].count() == 3
    assert not [p for p in (tmp_path / "v" / "manifest").iterdir() if p.name.startswith(".")]


def test_layouts_of_a_table_equal_those_of_a_list(spark):
    rng = random.Random(4)
    names = ["a1", "a2", "b", "cc", "d"]
    rows = [(rng.choice(names), i, rng.choice(["D1", "H1", ""]) + "|".join("".join(rng.choices("aZ9é |,", k=rng.randrange(9))) for _ in range(9))) for i in range(200)]
    lines = spark.createDataFrame(rows, "src string, line_no long, line string")
    given = [
        masking.fixed([(5, 9), (2, 3), (4, 4), (30, 60)], src_pattern="^a1"),
        masking.delimited("|", [0, 3, 99], src_pattern="^a"),
        masking.delimited(", ", [1], None, src_pattern="b"),
        masking.fixed([(0, 0)], "H", src_pattern="^c+$"),
        masking.fixed([(0, 1000)]),
    ]
    table = [
        (i, g.src_pattern, g.kind.lower(), [tuple(r) for r in g.ranges], g.delimiter, list(g.columns), g.row_prefix)
        for i, g in enumerate(given)
    ]
    rng.shuffle(table)
    layouts = spark.createDataFrame(table, LAYOUTS)
    for by_list, by_table in ((masking.mask_by_layout, mask_by_table), (masking.mask_audit, audit_by_table)):
        assert sorted(map(tuple, by_table(lines, layouts).collect())) == sorted(map(tuple, by_list(lines, given).collect()))
    plan = mask_by_table(lines, layouts)._jdf.queryExecution().optimizedPlan().toString()
    assert "rlike" not in plan.lower() and "NestedLoop" not in plan
    bad = [(None, "F", [(0, 1)], None, None), ("x", "Q", None, None, None), ("x", "F", [], None, None), ("x", "F", [(3, 2)], None, None), ("x", "D", None, "", [1]), ("x", "D", None, "|", [-1])]
    for pattern, kind, ranges, delimiter, columns in bad:
        one = spark.createDataFrame([(1, pattern, kind, ranges, delimiter, columns, None)], LAYOUTS)
        with pytest.raises(Exception, match="layout|structure|range|field"):
            mask_by_table(lines, one).collect()
    with pytest.raises(Exception, match="no mask layout"):
        mask_by_table(lines, layouts.limit(0)).collect()


@pytest.mark.parametrize("match", ["regex", "literal"])
def test_codes_of_a_table_equal_those_of_a_list(spark, match):
    rng = random.Random(9)
    bodies = [" AB", "ABC x", "  a.c", "A", "", "xAB-12 é", "日本AB", "(AB)", "AB.C", "zzABBBz"]
    rows = [(f"s{i % 3}", i, rng.choice(["CH", "CT", "D1"]) + rng.choice(bodies)) for i in range(150)]
    lines = spark.createDataFrame(rows, "src string, line_no long, line string")
    codes = ["AB", "ABC", "A", "a.c", "é", "日本", "none", "AB.*2", "AB+z", "B-1", "(AB|zz)", "x?AB", "[aA]B", "AB\\.C", ".", "A.C", "nono.*AB", "\\(AB\\)"]
    if match == "literal":
        codes += ["(AB)", "AB.C"]
    got = blocks.boundary_lines(lines, spark.createDataFrame([(c,) for c in [*codes, "AB", None]], "code string"), match)
    wanted = blocks.boundary_lines(lines, codes, match)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, wanted.collect()))
    everyone = blocks.boundary_lines(lines, spark.createDataFrame([("",)], "code string"), match)
    assert everyone.count() == sum(r[2][0] == "C" for r in rows)
    assert blocks.boundary_lines(lines, spark.createDataFrame([], "code string"), match).count() == 0


def test_ten_thousand_codes_need_no_nested_loop(spark):
    lines = spark.range(3000).select(
        F.lit("s").alias("src"), F.col("id").alias("line_no"), F.concat(F.lit("CH"), F.format_string("%06d", F.col("id") * 7)).alias("line")
    )
    codes = spark.range(10_000).select(F.format_string("%06d", "id").alias("code"))
    for match in ("regex", "literal"):
        found = blocks.boundary_lines(lines, codes, match)
        plan = found._jdf.queryExecution().executedPlan().toString()
        assert "NestedLoop" not in plan and "Cartesian" not in plan
        assert found.count() == len([i for i in range(3000) if i * 7 < 10_000])


def test_blocks_of_a_task_share_one_file(tmp_path):
    import pyarrow as pa

    from ledgerline.sinks import filewrite

    n = filewrite.REPORT_ROWS + 10
    rows = pa.RecordBatch.from_pydict(
        {"file": [f"f{i // 2:06d}" for i in range(n)], "block": pa.array([i % 2 for i in range(n)], pa.int64()), "line": [f"é{i}" for i in range(n)]}
    )
    batches = [rows.slice(at, 999) for at in range(0, n, 999)]
    found = [r for b in filewrite.block_rows(batches, f"{tmp_path}/blocks") for r in b.to_pylist()]
    assert len(found) == n and len({r["path"] for r in found}) == 1
    assert sum(r["bytes"] for r in found) == len(open(found[0]["path"], "rb").read())
    wanted = [{"file": "a/x", "cut": True, "blocks": found[7:9]}, {"file": "a/y", "cut": False, "blocks": found[-2:]}, {"file": "z", "cut": True, "blocks": None}]
    written = pa.RecordBatch.from_pylist(wanted)
    made = [r for b in filewrite.file_rows([written], f"{tmp_path}/out") for r in b.to_pylist()]
    text = {r["file"]: open(f"{tmp_path}/out/{r['file']}", encoding="utf-8").read() for r in made}
    assert text == {"a/x": "é7\né8", "a/y": f"é{n - 2}\né{n - 1}\n", "z": ""}
    assert [r["bytes"] for r in made] == [len(text[r["file"]].encode()) for r in made]
