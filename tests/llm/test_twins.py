"""Queries against their SQL twins."""

from __future__ import annotations

import duckdb
import pytest
from llm_helpers import SF_DIR

from authwatch.llm.queries import ORACLES, QUERIES


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, name):
    con = duckdb.connect()
    for table in ("documents", "pages", "embeddings"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{SF_DIR}/{table}.parquet')")
    want = con.sql(ORACLES[name])
    got = QUERIES[name](spark, SF_DIR)
    assert sorted(got.columns) == sorted(want.columns)
    order = [want.columns.index(c) for c in got.columns]
    assert sorted(map(tuple, got.collect()), key=str) == sorted(
        (tuple(row[n] for n in order) for row in want.fetchall()), key=str)
