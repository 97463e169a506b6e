"""Every registered query against DuckDB on the same tables."""

from __future__ import annotations

import sys
from pathlib import Path

import duckdb
import pytest

sys.path.insert(0, str(Path(__file__).parents[1]))

import __spark_entry__ as contract
from landfold.plans.queries import QUERIES

DATA = "/root/testdata/sf0.01"
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages"
    " benchmark labels conversations"
).split()

pytestmark = pytest.mark.skipif(not Path(DATA).exists(), reason="no test tables here")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{DATA}/{name}.parquet'")
    return con


def sorted_rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(r[i] for i in order) for r in rows), key=repr)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_its_sql(spark, duck, name):
    got = QUERIES[name](spark, DATA)
    result = duck.execute(contract.oracle_sql()[name])
    columns = [d[0] for d in result.description]
    assert sorted(got.columns) == sorted(columns)
    mine = sorted_rows(got.columns, [tuple(r) for r in got.collect()])
    theirs = sorted_rows(columns, result.fetchall())
    assert len(mine) == len(theirs) > 0
    assert mine == theirs


def test_entry(spark):
    assert contract.entry(spark).count() > 0
