"""Every registered query against its SQL on the smallest tables."""

import glob
import math
import os

import duckdb
import pytest

import __spark_entry__ as driver

FOLDER = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.001")
QUERIES, SQL = driver.all_queries(), driver.ORACLE


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for path in glob.glob(f"{FOLDER}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM '{path}'")
    yield con
    con.close()


def values(names, table):
    order = sorted(range(len(names)), key=lambda i: names[i])

    def plain(v):
        if isinstance(v, float) and math.isnan(v):
            return None
        return v

    return sorted((tuple(plain(r[i]) for i in order) for r in table), key=str)


def test_every_query_has_its_sql():
    assert QUERIES.keys() == SQL.keys()


@pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables")
@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, name):
    got = QUERIES[name](spark, FOLDER)
    want = duck.execute(SQL[name])
    columns = [c[0] for c in want.description]
    assert sorted(got.columns) == sorted(columns)
    expected = values(columns, want.fetchall())
    found = values(got.columns, [tuple(r) for r in got.collect()])
    assert found == expected
    for a, b in zip(found, expected):
        assert [type(x) for x in a] == [type(x) for x in b]
