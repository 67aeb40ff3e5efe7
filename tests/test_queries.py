"""Every registered query against its SQL on the smallest test data."""

import math
import os

import duckdb
import pytest

from __spark_entry__ import entry, oracle_sql, queries
from millrace.catalog import QUERIES

SF = "/root/testdata/sf0.001"
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()

pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test data")


@pytest.fixture(scope="module")
def db():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return con


def plain(v):
    return "nan" if isinstance(v, float) and math.isnan(v) else repr(v) if v is None else str(v)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, db, name):
    df = queries()[name](spark, SF)
    cols = sorted(df.columns)
    got = sorted(tuple(plain(r[c]) for c in cols) for r in df.collect())
    result = db.execute(oracle_sql()[name])
    have = [d[0] for d in result.description]
    assert sorted(have) == cols
    want = sorted(tuple(plain(r[have.index(c)]) for c in cols) for r in result.fetchall())
    assert got == want
    assert got


def test_entry(spark):
    assert entry(spark).limit(1).count() == 1
