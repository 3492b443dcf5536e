"""Every registered query that has SQL, against DuckDB on the smallest tables."""

import os

import duckdb
import pandas as pd
import pytest

from roadflux.plans.catalogue import QUERIES
from roadflux.plans.oracle import ORACLES

DATA = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(DATA), reason="no test tables")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for name in os.listdir(DATA):
        con.execute(f"CREATE VIEW {name.removesuffix('.parquet')} AS SELECT * FROM '{DATA}/{name}'")
    return con


def plain(value):
    if value is None or value != value:
        return "None"
    return str(round(float(value), 5) + 0.0) if isinstance(value, float) else str(value.isoformat() if isinstance(value, pd.Timestamp) else value)


def table(names, rows):
    order = sorted(range(len(names)), key=names.__getitem__)
    return [names[i] for i in order], sorted(tuple(plain(r[i]) for i in order) for r in rows)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, name):
    df = QUERIES[name](spark, DATA)
    rows = [tuple(r) for r in df.collect()]
    if name not in ORACLES:
        assert rows
        return
    found = duck.execute(ORACLES[name])
    assert table(df.columns, rows) == table([d[0] for d in found.description], found.fetchall())


def test_entry_and_names():
    import __spark_entry__ as entry

    assert set(ORACLES) <= set(QUERIES) <= set(entry.queries())
    assert set(entry.oracle_sql()) <= set(entry.queries())
