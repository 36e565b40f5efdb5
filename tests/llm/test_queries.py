"""Registered queries against their SQL on the smallest tables."""

import duckdb
import pytest

from ledgerline.llm import queries

FOLDER = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "embeddings", "pages", "benchmark"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{FOLDER}/{t}.parquet'")
    want = con.sql(queries.SQL[name])
    got = queries.QUERIES[name](spark, FOLDER)
    columns = sorted(got.columns)
    assert columns == sorted(want.columns)
    assert sorted(map(repr, (tuple(r[c] for c in columns) for r in got.collect()))) == sorted(
        map(repr, want.project(", ".join(columns)).fetchall())
    )
