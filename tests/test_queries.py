"""Every registered query with SQL, against DuckDB on the smallest tables."""

import os

import duckdb
import pytest

import __spark_entry__ as entry

FOLDER = "/root/testdata/sf0.001"
TABLES = "customer events lineitem nation orders part region supplier".split()
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables")
SQL = entry.retail_sql.sql(entry.RULE_TAGS)


@pytest.fixture(scope="module")
def db():
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(
            f"CREATE VIEW {table} AS SELECT * FROM '{FOLDER}/{table}.parquet'")
    return connection


def in_name_order(columns, rows):
    places = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(repr(row[i]) for i in places) for row in rows)


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_its_sql(spark, db, name):
    found = entry.queries()[name](spark, FOLDER)
    result = db.execute(SQL[name])
    columns = [d[0] for d in result.description]
    assert sorted(columns) == sorted(found.columns)
    assert in_name_order(found.columns, found.collect()) == in_name_order(
        columns, result.fetchall())


def test_every_sql_has_a_query():
    assert set(SQL) <= set(entry.queries())


def test_entry(spark):
    assert 0 < entry.entry(spark).count() <= 15
