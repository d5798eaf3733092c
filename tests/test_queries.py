"""Every registered query against its SQL on DuckDB; CAIRN_SF_DIR chooses the tables."""

import os
from collections import Counter

import duckdb
import pytest

import __spark_entry__ as contract

SF_DIR = os.environ.get("CAIRN_SF_DIR", "/root/testdata/sf0.001")
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF_DIR}/{name}.parquet'")
    return connection


def frozen(value):
    """Nested values as something that can be counted."""
    if isinstance(value, dict):
        return frozenset((frozen(key), frozen(item)) for key, item in value.items())
    return tuple(map(frozen, value)) if isinstance(value, list | tuple) else value


@pytest.mark.parametrize("name", sorted(contract.queries()))
def test_query_matches_oracle(spark, duck, name):
    result = contract.queries()[name](spark, SF_DIR)
    order = sorted(result.columns)
    rows = Counter(tuple(frozen(row[column]) for column in order) for row in result.collect())
    sql = contract.oracle_sql().get(name)
    if sql is None:
        assert rows
        return
    expected = duck.execute(sql)
    columns = [description[0] for description in expected.description]
    assert sorted(columns) == order
    places = [columns.index(column) for column in order]
    assert rows == Counter(tuple(frozen(row[place]) for place in places) for row in expected.fetchall())


def test_entry(spark):
    assert contract.entry(spark).count() > 0
