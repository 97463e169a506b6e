"""Queries that SQL can express, against DuckDB on the same tables."""

from __future__ import annotations

from pathlib import Path

import duckdb
import pytest

from landfold.llm.queries import ORACLES, QUERIES

DATA = "/root/testdata/sf0.001"

pytestmark = pytest.mark.skipif(not Path(DATA).exists(), reason="no test tables here")


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_its_sql(spark, name):
    duck = duckdb.connect()
    for t in ("documents", "pages", "conversations", "embeddings"):
        duck.execute(f"CREATE VIEW {t} AS SELECT * FROM '{DATA}/{t}.parquet'")
    got = QUERIES[name](spark, DATA)
    want = duck.execute(ORACLES[name])
    columns = [d[0] for d in want.description]
    assert sorted(got.columns) == sorted(columns)
    assert sorted(map(tuple, got.select(columns).collect()), key=repr) == sorted(want.fetchall(), key=repr)
