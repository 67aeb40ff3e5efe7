"""Queries with SQL against DuckDB on the smallest test data, and the registration."""

import os
import re

import duckdb
import pytest

from __spark_entry__ import oracle_sql, queries
from millrace.llm.queries import QUERIES, SQL

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test data")


def test_registered():
    names = [n for n in queries() if re.match(r"op\d+_", n)]
    assert sorted(int(re.match(r"op(\d+)", n)[1]) for n in names) == list(range(1, 14))
    assert "pipeline" in queries()
    assert set(SQL) <= set(oracle_sql())


@pytest.mark.parametrize("name", sorted(SQL))
def test_query(spark, name):
    con = duckdb.connect()
    for t in ("documents", "pages", "conversations"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    df = QUERIES[name](spark, SF)
    cols = sorted(df.columns)
    got = sorted(tuple(str(r[c]) for c in cols) for r in df.collect())
    result = con.execute(SQL[name])
    have = [d[0] for d in result.description]
    assert sorted(have) == cols
    assert got == sorted(tuple(str(r[have.index(c)]) for c in cols) for r in result.fetchall())
    assert got
