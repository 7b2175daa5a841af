"""Every query with SQL against DuckDB over the whole small tables."""

import datetime
import math
import os

import pytest

import __spark_entry__ as entry

DATA = "/root/testdata"

SF = f"{DATA}/sf0.001"
SQL = entry.oracle_sql()
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test data")


def plain(v):
    if v is None or isinstance(v, float) and math.isnan(v):
        return None
    if isinstance(v, bool):
        return v
    if isinstance(v, float):
        return round(v, 6)
    if isinstance(v, (datetime.datetime, datetime.date)):
        return v.isoformat()
    return v


@pytest.fixture(scope="module")
def duck():
    import duckdb

    con = duckdb.connect()
    for f in os.listdir(SF):
        con.execute(f"create view {f.split('.')[0]} as select * from '{SF}/{f}'")
    return con


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_sql(spark, duck, name):
    df = entry.queries()[name](spark, SF)
    cols = sorted(df.columns)
    rel = duck.sql(SQL[name])
    assert sorted(rel.columns) == cols
    order = [rel.columns.index(c) for c in cols]
    key = lambda r: tuple(map(str, r))
    got = sorted((tuple(plain(r[c]) for c in cols) for r in df.collect()), key=key)
    want = sorted((tuple(plain(r[i]) for i in order) for r in rel.fetchall()), key=key)
    assert got == want


@pytest.mark.parametrize("name", sorted(set(entry.queries()) - set(SQL)))
def test_query_without_sql_gives_whole_rows_once(spark, name):
    """The values are held against a second implementation in the tests of each operator; here: rows, keys and repeatability."""
    run = lambda: sorted((tuple(map(str, r)) for r in entry.queries()[name](spark, SF).collect()))
    rows = run()
    assert rows and len(rows) == len(set(rows))
    assert all(set(r) != {"None"} for r in rows)
    assert run() == rows


def test_entry(spark):
    assert entry.entry(spark).count() > 0
