"""Every registered query against DuckDB, value by value."""

import decimal
import math

import duckdb
import pytest
from sf_tables import SF_ORACLE

from __spark_entry__ import oracle_sql, queries
from sluicebox.catalog.oracle import ORACLE
from sluicebox.catalog.queries import QUERIES

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels"
    " conversations"
).split()


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF_ORACLE}/{table}.parquet'")
    yield connection
    connection.close()


def plain(value):
    if isinstance(value, float) and math.isnan(value):
        return "NaN"
    if isinstance(value, float):
        return value + 0.0  # both zeros are the same amount
    if isinstance(value, decimal.Decimal):
        return str(value.normalize())
    return value


def sorted_rows(columns, rows):
    order = sorted(range(len(columns)), key=columns.__getitem__)
    return sorted((tuple(plain(row[i]) for i in order) for row in rows), key=repr)


def test_every_query_has_expected_sql():
    assert set(QUERIES) == set(ORACLE)
    assert set(QUERIES) <= set(queries()) and set(ORACLE) <= set(oracle_sql())


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_matches_sql(spark, duck, name):
    frame = queries()[name](spark, SF_ORACLE)
    got = [tuple(r) for r in frame.collect()]
    result = duck.execute(oracle_sql()[name])
    columns = [d[0] for d in result.description]
    want = result.fetchall()
    assert sorted(frame.columns) == sorted(columns)
    assert len(got) == len(want) > 0
    pairs = list(zip(sorted_rows(frame.columns, got), sorted_rows(columns, want)))
    wrong = [pair for pair in pairs if pair[0] != pair[1]]
    assert not wrong, (len(wrong), wrong[:3])
