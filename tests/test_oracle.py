"""Every query with SQL against DuckDB on the same tables: schema, row count and values."""

import math

import duckdb
import pytest

import __spark_entry__ as contract
from tallywatch.plans import catalog

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()
ORACLES = {k: v for k, v in contract.oracle_sql().items() if k in catalog.QUERIES}
RELATIVE = 1e-9


@pytest.fixture(scope="module")
def duck(data):
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(
            f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{data}/{table}.parquet')"
        )
    return connection


def canonical(row):
    return tuple(
        "NaN" if isinstance(v, float) and math.isnan(v) else v for v in row
    )


def sort_key(row):
    return tuple((v is None, str(v)) for v in row)


def test_every_query_has_sql():
    assert set(catalog.QUERIES) <= set(contract.queries())
    assert set(catalog.QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_matches_duckdb(spark, duck, data, name):
    result = contract.queries()[name](spark, data)
    expected = duck.execute(ORACLES[name])
    columns = sorted(result.columns)
    names = [d[0] for d in expected.description]
    assert columns == sorted(names)
    ours = sorted((canonical(tuple(r[c] for c in columns)) for r in result.collect()), key=sort_key)
    order = [names.index(c) for c in columns]
    theirs = sorted(
        (canonical(tuple(r[i] for i in order)) for r in expected.fetchall()), key=sort_key
    )
    assert len(ours) == len(theirs) > 0
    for left, right in zip(ours, theirs):
        for column, a, b in zip(columns, left, right):
            assert type(a) is type(b), (column, a, b)
            assert a == b, (column, left, right)
