"""Every registered query against its SQL twin, on the smallest tables."""

import datetime

import duckdb
import pytest

import __spark_entry__ as entry

from conftest import SMALL

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark "
          "labels conversations").split()
SPARK_TO_SQL = {
    "bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "double": "DOUBLE", "boolean": "BOOLEAN",
}


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SMALL}/{table}.parquet'")
    return connection


def plain(value):
    if isinstance(value, datetime.datetime):
        return value.isoformat()
    return 0.0 if isinstance(value, float) and value == 0 else value


def ordered(records):
    return sorted(records, key=lambda r: [(x is None, str(x)) for x in r])


@pytest.mark.parametrize("name", sorted(entry.queries()))
def test_same_as_sql(spark, duck, name):
    df = entry.queries()[name](spark, SMALL)
    columns = sorted(df.columns)
    got = ordered(tuple(plain(r[c]) for c in columns) for r in df.collect())
    sql = entry.oracle_sql().get(name)
    if sql is None:
        assert got
        return
    cursor = duck.execute(sql)
    names = [d[0] for d in cursor.description]
    assert sorted(names) == columns
    kinds = {d[0]: str(d[1]) for d in cursor.description}
    assert {f.name: SPARK_TO_SQL.get(f.dataType.simpleString()) for f in df.schema} == kinds
    place = [names.index(c) for c in columns]
    assert got == ordered(tuple(plain(r[i]) for i in place) for r in cursor.fetchall())


def test_entry(spark):
    df = entry.entry(spark)
    assert df.columns == ["by_segment", "doc_count", "total"]
    assert df.count() > 0


def test_every_twin_has_its_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())
