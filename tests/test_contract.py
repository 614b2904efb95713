"""Differential check: every registered query against its DuckDB oracle on the
smallest generated tables (the round driver does the same at sf0.01)."""

import datetime as dt
import decimal
import os

import duckdb
import pytest

import __spark_entry__ as E
from gamelake.plans import contract

NAMES = sorted(contract.load_all())
TYPES = {"string": "VARCHAR", "int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE", "boolean": "BOOLEAN",
         "date": "DATE", "timestamp": "TIMESTAMP"}
TABLES = ["lineitem", "orders", "part", "customer", "supplier", "nation", "region"]


def norm(v):
    if isinstance(v, float):
        return repr(0.0 if v == 0 else v)
    if isinstance(v, decimal.Decimal):
        return repr(float(v))
    if isinstance(v, (dt.date, dt.datetime)):
        return v.isoformat()
    if isinstance(v, (list, tuple)):
        return tuple(norm(x) for x in v)
    return v


def canon(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted(repr(tuple(norm(r[i]) for i in order)) for r in rows)


@pytest.fixture(scope="module")
def con(sf):
    c = duckdb.connect()
    for t in TABLES:
        p = f"{sf}/{t}.parquet"
        if os.path.exists(p):
            c.execute(f"create view {t} as select * from read_parquet('{p}')")
    return c


def test_every_query_has_an_oracle():
    assert set(NAMES) <= set(E.oracle_sql()) and set(NAMES) <= set(E.queries())


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, sf, con, name):
    df = E.queries()[name](spark, sf)
    srows = [tuple(r) for r in df.collect()]
    rel = con.sql(E.oracle_sql()[name])
    ocols, otypes = rel.columns, [str(t) for t in rel.types]
    assert sorted(df.columns) == sorted(ocols)
    types = dict(zip(ocols, otypes))
    assert {c: TYPES.get(t, t) for c, t in df.dtypes} == {c: types[c] for c in df.columns}
    assert canon(df.columns, srows) == canon(ocols, rel.fetchall())


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0
