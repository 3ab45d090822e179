"""Every query with a SQL twin gives the rows DuckDB gives; the others give rows."""

import datetime as dt
import math

import duckdb
import pytest

import __spark_entry__ as entry_module
from panelwright.workload import catalogue
from conftest import DATA, TABLES

QUERIES, SQL = catalogue.queries(), catalogue.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{DATA}/{t}.parquet'")
    return con


def _plain(v):
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 6) + 0.0
    if isinstance(v, dt.datetime):
        return v.date() if v.time() == dt.time(0) else v
    if isinstance(v, bool) or v is None or isinstance(v, (int, str, dt.date)):
        return v
    return round(float(v), 6)


def _sorted(rows):
    return sorted(rows, key=lambda r: tuple((x is None, str(x)) for x in r))


def test_every_twin_has_a_query():
    assert set(SQL) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_its_twin(spark, duck, name):
    df = QUERIES[name](spark, DATA)
    columns = sorted(df.columns)
    got = _sorted([tuple(_plain(r[n]) for n in columns) for r in df.collect()])
    cursor = duck.execute(SQL[name])
    names = [d[0] for d in cursor.description]
    assert sorted(names) == columns
    at = [names.index(n) for n in columns]
    want = _sorted([tuple(_plain(r[i]) for i in at) for r in cursor.fetchall()])
    assert got == want


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(SQL)))
def test_query_gives_rows(spark, name):
    assert QUERIES[name](spark, DATA).count() > 0


def test_entry(spark):
    assert entry_module.entry(spark).count() > 0
