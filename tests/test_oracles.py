"""Each query against its SQL on the test tables."""

import datetime
import os

import duckdb
import pytest

import __spark_entry__ as entry
from quizloom.plans.catalog import ORACLES, QUERIES

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF_DIR}/{name}.parquet'")
    return connection


def sort_key(row):
    return tuple((value is not None, str(value)) for value in row)


def canonical(value):
    if isinstance(value, datetime.datetime):
        return value.isoformat()
    return value


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    picked = [tuple(canonical(row[i]) for i in order) for row in rows]
    return sorted(picked, key=sort_key)


def kind(name):
    name = name.lower()
    names = {"bigint": "long", "integer": "int", "varchar": "string", "double": "double"}
    return names.get(name, name)


def test_entry_has_all_queries():
    assert set(QUERIES) == set(ORACLES)
    assert QUERIES.items() <= entry.queries().items()
    assert ORACLES.items() <= entry.oracle_sql().items()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_its_sql(spark, duck, name):
    frame = QUERIES[name](spark, SF_DIR)
    spark_rows = [tuple(row) for row in frame.collect()]
    sql = ORACLES[name]
    cursor = duck.execute(sql)
    columns = [d[0] for d in cursor.description]
    expected = cursor.fetchall()
    assert sorted(frame.columns) == sorted(columns)
    types = {d[0]: kind(str(d[1])) for d in cursor.description}
    spark_types = {f.name: f.dataType.simpleString() for f in frame.schema.fields}
    spark_types = {n: {"bigint": "long"}.get(t, t) for n, t in spark_types.items()}
    assert spark_types == types
    got, want = rows_of(frame.columns, spark_rows), rows_of(columns, expected)
    assert len(got) == len(want)
    assert len(want) > 0
    for one, other in zip(got, want):
        assert one == other
