"""WARC records in packages: directories, ranges, revisits."""

import io
import zipfile

import pytest

from ledgerline.llm import packages
from ledgerline.llm.common import new_shared_path


def package_of(data: bytes) -> packages.Package:
    return packages.Package(lambda offset, size: data[offset : offset + size], len(data))


def archive(members, comment=b"", method=zipfile.ZIP_STORED, zip64=False):
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w", method) as z:
        for name, data in members:
            with z.open(zipfile.ZipInfo(name) if method == zipfile.ZIP_STORED else name, "w", force_zip64=zip64) as f:
                f.write(data)
        z.comment = comment
    return out.getvalue()


@pytest.mark.parametrize("comment", [b"", b"note", b"PK\x05\x06" + b"\0" * 30])
def test_members_and_ranges(comment):
    package = package_of(archive([("a/ä.txt", b"0123456789"), ("b", b""), ("c", b"x\ny\n\nz")], comment))
    member = package.member("a/ä.txt")
    assert member.size == 10 and package.read(member, 3, 4) == b"3456"
    assert package.member("b").size == 0
    assert list(package.lines(package.member("c"), piece=2)) == [b"x", b"y", b"", b"z"]
    with pytest.raises(ValueError):
        package.read(member, 8, 3)
    with pytest.raises(KeyError):
        package.member("d")


def test_zip64_directory(monkeypatch):
    # Python's writer takes the ZIP64 forms beyond these limits; with small ones any archive needs them.
    monkeypatch.setattr(zipfile, "ZIP64_LIMIT", 4)
    monkeypatch.setattr(zipfile, "ZIP_FILECOUNT_LIMIT", 2)
    data = archive([(f"m{i}", bytes([65 + i]) * (10 + i)) for i in range(5)], zip64=True)
    assert packages._END64 in data and packages._END64_PLACE in data
    package = package_of(data)
    for i in range(5):
        member = package.member(f"m{i}")
        assert package.read(member, 0, member.size) == bytes([65 + i]) * (10 + i)
    assert [n for n, *_ in package.entries(piece=50)] == [f"m{i}" for i in range(5)]


def test_wide_fields_are_read_where_full():
    import struct

    extra = struct.pack("<HHQQ", 1, 16, 5_000_000_000, 6_000_000_000)
    assert packages._widened(extra, 0xFFFFFFFF, 7, 0xFFFFFFFF) == (5_000_000_000, 7, 6_000_000_000)


def test_refuses_what_has_no_ranges():
    with pytest.raises(ValueError, match="compressed"):
        package_of(archive([("a", b"x" * 100)], method=zipfile.ZIP_DEFLATED)).member("a")
    with pytest.raises(ValueError, match="end record"):
        package_of(b"no archive" * 10).member("a")
    with pytest.raises(ValueError, match="cut off"):
        list(packages.records_of(b"WARC/1.1\r\nContent-Length: 9\r\n\r\nabc"))


SCHEMA = "page_id long, url string, html string, uri string"


def round_trip(spark, rows, min_bytes=0, package_bytes=2000, run_bytes=700):
    pages = spark.createDataFrame(rows, SCHEMA)
    typed = packages.with_types(pages, min_bytes)
    manifest = packages.write_packages(typed, new_shared_path(spark, "test-packages"), package_bytes)
    runs = packages.record_runs(manifest.df, run_bytes)
    return manifest, runs, [r.asDict() for r in packages.read_records(runs).collect()]


def test_round_trip(spark):
    import base64
    import hashlib

    rows = [(i, f"http://x/{i}", f"<p>page {i % 7}</p>é" * (1 + i % 7), "u") for i in range(60)]
    rows += [(100, None, None, "u"), (101, "a\r\nb: c", "", "u"), (102, "u", "x" * 50_000, "u"), (None, "n", "only", "u"), (None, "n", rows[0][2], "u")]
    manifest, runs, got = round_trip(spark, rows)
    assert len(got) == len(rows) and manifest.rows > 1 and runs.count() > manifest.rows
    best = {}
    for i, _, html, _ in rows:
        best[html or ""] = max(best.get(html or "", -1), -1 if i is None else i)
    of = {(i, html or "") for i, _, html, _ in rows}
    by_digest = {base64.b32encode(hashlib.sha1(h.encode()).digest()).decode(): h for _, h in of}
    for r in got:
        html = by_digest[r["payload_digest"]]
        assert (r["page_id"], html) in of and r["payload_bytes"] == len(html.encode())
        if (r["page_id"] if r["page_id"] is not None else -1) == best[html]:
            assert r["record_type"] == "response" and r["refers_to"] is None and r["payload"] == html.encode()
        else:
            assert r["record_type"] == "revisit" and r["refers_to"] == best[html] and r["payload"] is None


def test_small_payloads_and_repeated_rows(spark):
    rows = [(1, "u", "short", "u"), (2, "u", "short", "u"), (3, "u", "long enough", "u"), (4, "u", "long enough", "u"), (4, "u", "long enough", "u")]
    _, _, got = round_trip(spark, rows, min_bytes=8)
    assert sorted((r["page_id"], r["record_type"]) for r in got) == [(1, "response"), (2, "response"), (3, "revisit"), (4, "response"), (4, "response")]


def test_empty_table(spark):
    manifest, _, got = round_trip(spark, [])
    assert manifest.rows == 0 and got == []


def test_tasks_follow_the_bytes_that_ranges_point_to(spark):
    few = spark.range(100).selectExpr("'u' as uri", "id as start", "1L as length")
    assert packages.dealt(few, 40 * packages.TASK_BYTES).rdd.getNumPartitions() == 40
    assert packages.dealt(few, 10).rdd.getNumPartitions() == 1
    parallel = spark.sparkContext.defaultParallelism
    assert packages.dealt(few, 3 * packages.TASK_BYTES).rdd.getNumPartitions() == parallel
