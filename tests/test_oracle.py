"""Every registered query against its SQL on the shared tables."""

import math
import os

import duckdb
import pytest

import __spark_entry__ as entry_point
from queries import ORACLES, QUERIES

FOLDER = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.01")
TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark "
          "labels conversations").split()
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no shared tables")


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for table in TABLES:
        c.execute(f"CREATE VIEW {table} AS SELECT * FROM '{FOLDER}/{table}.parquet'")
    return c


def cell(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value + 0.0)
    return repr(value)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(entry_point.queries())


def test_entry(spark):
    rows = entry_point.entry(spark).collect()
    assert rows and all(r["has_exceedance"] for r in rows)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, con, name):
    frame = QUERIES[name](spark, FOLDER)
    order = sorted(frame.columns)
    got = sorted([cell(r[c]) for c in order] for r in frame.collect())
    result = con.execute(ORACLES[name])
    names = [c[0] for c in result.description]
    assert sorted(names) == order
    want = sorted([cell(r[names.index(c)]) for c in order] for r in result.fetchall())
    assert got == want
