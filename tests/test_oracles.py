"""Every registered query against its SQL counterpart, value for value."""

from __future__ import annotations

import duckdb
import pytest

import __spark_entry__ as entry_points
from waymill.registry import ORACLES, QUERIES

FOLDER = "/root/testdata/sf0.001"
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


@pytest.fixture(scope="module")
def database():
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{FOLDER}/{table}.parquet'")
    yield connection
    connection.close()


def _sorted(names, records):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(names), sorted(tuple(repr(record[i]) for i in order) for record in records)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_oracle(spark, database, name):
    df = QUERIES[name](spark, FOLDER)
    result = database.execute(ORACLES[name])
    expected = _sorted([d[0] for d in result.description], result.fetchall())
    assert _sorted(df.columns, df.collect()) == expected


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(entry_points.queries())
    assert set(ORACLES) <= set(entry_points.oracle_sql())


def test_entry_runs(spark):
    df = entry_points.entry(spark)
    assert len(df.columns) == 14 and df.count() > 0
