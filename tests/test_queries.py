"""Every query against its SQL twin on the smallest data folder."""

from collections import Counter
from decimal import Decimal

import duckdb
import pytest

import __spark_entry__ as entry

FOLDER = "/root/testdata/sf0.001"
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"create view {name} as select * from '{FOLDER}/{name}.parquet'")
    return con


def plain(value):
    if isinstance(value, Decimal):
        value = float(value)
    return round(value, 9) if isinstance(value, float) else value


def bag(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(plain(row[i]) for i in order) for row in rows)


def test_every_query_has_a_twin():
    assert set(entry.QUERIES) == set(entry.ORACLES)


@pytest.mark.parametrize("name", sorted(entry.QUERIES))
def test_query_equals_sql(spark, duck, name):
    df = entry.queries()[name](spark, FOLDER)
    cursor = duck.execute(entry.oracle_sql()[name])
    columns = [d[0] for d in cursor.description]
    expected = bag(columns, cursor.fetchall())
    assert sorted(df.columns) == sorted(columns)
    assert bag(df.columns, df.collect()) == expected
    assert expected


def test_entry(spark):
    assert entry.entry(spark).count() == 1000
