"""Every registered query against its SQL, on the smallest data."""

import math
import sys
from pathlib import Path

import duckdb
import pytest

sys.path.insert(0, str(Path(__file__).parents[1]))
import __spark_entry__ as entry

SF = "/root/testdata/sf0.001"
ORACLES = entry.oracle_sql()
# Queries of the optional subpackage have tests of their own.
EXTRA = set(entry.llm_queries.queries()) | {"pipeline"} if entry.llm_queries else set()
QUERIES = {name: query for name, query in entry.queries().items() if name not in EXTRA}


@pytest.fixture(scope="module")
def tables():
    connection = duckdb.connect()
    for name in entry.TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF}/{name}.parquet'")
    return connection


def plain(value):
    if isinstance(value, bool) or value is None or isinstance(value, str):
        return value
    if isinstance(value, (int, float)):
        return None if math.isnan(value) else float(value)
    return str(value)


def sorted_rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(plain(row[i]) for i in order) for row in rows), key=repr)


def test_every_query_has_its_sql():
    assert set(QUERIES) == set(ORACLES) - EXTRA


@pytest.mark.parametrize("name", QUERIES)
def test_query_agrees_with_sql(spark, tables, name):
    got = QUERIES[name](spark, SF)
    want = tables.execute(ORACLES[name])
    columns = [c[0] for c in want.description]
    assert sorted(got.columns) == sorted(columns)
    assert sorted_rows(got.columns, got.collect()) == sorted_rows(columns, want.fetchall())


def test_flagship(spark):
    assert entry.entry(spark).first().passed
