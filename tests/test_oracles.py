"""Each registered query against its SQL on the smallest inputs."""

import os

import duckdb
import pytest

import __spark_entry__ as contract
from workload import oracles
from workload.queries import REGISTRY

QUERIES, SQL = REGISTRY, oracles.all_sql()


@pytest.fixture(scope="module")
def duck(sf):
    con = duckdb.connect()
    for name in os.listdir(sf):
        con.execute(f"create view {name.removesuffix('.parquet')} as from '{sf}/{name}'")
    return con


def _plain(v):
    return float(v) if isinstance(v, (int, float)) and not isinstance(v, bool) else v


def _sorted(rows):
    return sorted(rows, key=lambda r: [(v is not None, str(v)) for v in r])


def test_every_query_has_sql():
    assert QUERIES.keys() == SQL.keys()
    assert QUERIES.keys() <= contract.queries().keys() and SQL.keys() <= contract.oracle_sql().keys()


@pytest.mark.parametrize("name", QUERIES)
def test_query_equals_sql(spark, duck, sf, name):
    df = QUERIES[name](spark, sf)
    columns = sorted(df.columns)
    got = _sorted([tuple(_plain(r[c]) for c in columns) for r in df.collect()])
    cursor = duck.execute(SQL[name])
    names = [d[0] for d in cursor.description]
    assert sorted(names) == columns
    want = [tuple(_plain(r[names.index(c)]) for c in columns) for r in cursor.fetchall()]
    assert got == _sorted(want)


def test_entry(spark):
    assert contract.entry(spark).count() > 0
