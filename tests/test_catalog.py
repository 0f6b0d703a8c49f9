"""Every query that has SQL gives the rows DuckDB gives on the same tables."""

import datetime as dt
import glob
import os

import duckdb
import pytest
from conftest import SMALL

import __spark_entry__ as entry_point
from contest_analytics.plans import catalog, oracle

QUERIES = catalog.queries()
SQL = oracle.statements()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for path in glob.glob(f"{SMALL}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM '{path}'")
    yield con
    con.close()


def comparable(value):
    if isinstance(value, bool) or value is None or isinstance(value, str):
        return str(value)
    if isinstance(value, dt.datetime):
        return value.isoformat()
    return repr(float(value))


def normalized(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(comparable(row[i]) for i in order) for row in rows)


@pytest.mark.parametrize("name", sorted(SQL))
def test_equal_rows(spark, duck, name):
    df = QUERIES[name](spark, SMALL)
    found = duck.execute(SQL[name])
    columns = [c[0] for c in found.description]
    assert sorted(df.columns) == sorted(columns)
    assert normalized(df.columns, [tuple(r) for r in df.collect()]) == normalized(columns, found.fetchall())


def test_every_query_has_sql():
    assert set(SQL) == set(QUERIES)


def test_entry(spark):
    top = entry_point.entry(spark)
    assert top.columns == ["entity_id", "avg_pick_rate", "pick_rate_volatility", "avg_ban_rate"]
    spread = [r.pick_rate_volatility for r in top.collect()]
    assert len(spread) == 10 and spread == sorted(spread, reverse=True)


def test_full_profile_fit(spark):
    row = QUERIES["train_linear"](spark, SMALL).first()
    assert row.model == "linear_regression" and row.beats_guess


def test_entry_point_registers_all():
    assert set(QUERIES) <= set(entry_point.queries()) and set(SQL) <= set(entry_point.oracle_sql())
