"""Every query with an oracle gives the rows of its SQL in DuckDB, at the smallest scale."""

import os

import duckdb
import pytest

from attestor.plans.catalogue import ORACLE_SQL, QUERIES

FOLDER = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"create view {t} as select * from '{FOLDER}/{t}.parquet'")
    return con


def plain(x):
    if x is None:
        return "NULL"
    return f"{x:.6f}" if isinstance(x, float) else str(x)


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_rows_equal_those_of_the_sql(spark, duck, name):
    ours = QUERIES[name](spark, FOLDER)
    theirs = duck.sql(ORACLE_SQL[name])
    columns = sorted(ours.columns)
    assert columns == sorted(theirs.columns)
    a = sorted(tuple(map(plain, r)) for r in ours.select(*columns).collect())
    order = [theirs.columns.index(c) for c in columns]
    b = sorted(tuple(plain(r[i]) for i in order) for r in theirs.fetchall())
    assert a == b


def test_queries_without_sql_have_rows(spark):
    for name in set(QUERIES) - set(ORACLE_SQL):
        assert QUERIES[name](spark, FOLDER).count() > 0
