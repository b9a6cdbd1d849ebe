"""Every registered query against its SQL twin, on the smallest test data."""

from __future__ import annotations

import math

import __spark_entry__ as entry_points
import duckdb
import pytest
from conftest import SF_DIR

from flightmarts import catalog
from oracle import sql as twins

TABLES = ["lineitem", "events", "orders"]
NAMES = sorted(catalog.queries())


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(
            f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{SF_DIR}/{table}.parquet')"
        )
    return connection


def plain(value):
    if isinstance(value, float):
        return None if math.isnan(value) else repr(value)
    return value if value is None else str(value)


def rows(columns, records):
    order = sorted(range(len(columns)), key=columns.__getitem__)
    picked = [tuple(plain(record[i]) for i in order) for record in records]
    return sorted(picked, key=lambda r: [(v is not None, v or "") for v in r])


def test_every_query_has_a_twin():
    assert set(catalog.queries()) == set(twins.oracle_sql())


@pytest.mark.parametrize("name", NAMES)
def test_query_equals_its_twin(spark, duck, name):
    df = catalog.queries()[name](spark, SF_DIR)
    sql = twins.oracle_sql()[name]
    types = {r[0]: r[1] for r in duck.execute(f"DESCRIBE {sql}").fetchall()}
    names = {
        "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR",
        "boolean": "BOOLEAN", "timestamp": "TIMESTAMP",
    }
    assert {c: names[t] for c, t in df.dtypes} == types
    result = duck.execute(sql)
    columns = [d[0] for d in result.description]
    expected = rows(columns, result.fetchall())
    actual = rows(df.columns, df.collect())
    assert actual == expected
    assert actual


def test_entry_runs(spark):
    assert entry_points.entry(spark).count() > 0
