"""Every query with a SQL twin gives the twin's rows."""

import glob
import math
import os

import duckdb
import pytest

from __spark_entry__ import entry, oracle_sql, queries

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test data here")


@pytest.fixture(scope="module")
def database():
    connection = duckdb.connect()
    for path in glob.glob(f"{SF}/*.parquet"):
        name = os.path.basename(path)[: -len(".parquet")]
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return connection


def plain(value):
    if isinstance(value, float):
        return None if math.isnan(value) else repr(value)
    return value if value is None else str(value)


def table(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return [names[i] for i in order], sorted(
        (tuple(plain(row[i]) for i in order) for row in rows), key=repr
    )


@pytest.mark.parametrize("name", sorted(oracle_sql()))
def test_same_rows(name, spark, database):
    frame = queries()[name](spark, SF)
    cursor = database.execute(oracle_sql()[name])
    theirs = table([d[0] for d in cursor.description], cursor.fetchall())
    assert table(frame.columns, frame.collect()) == theirs


def test_every_sql_has_a_query():
    assert set(oracle_sql()) <= set(queries())


def test_entry_returns_rows(spark):
    frame = entry(spark)
    assert frame.count() > 0
    assert {"station", "ts", "air_index", "category"} <= set(frame.columns)
