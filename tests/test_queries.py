"""Every registered query against its SQL, on the smallest tables."""

from __future__ import annotations

import math
from datetime import date, datetime

import duckdb
import pytest

from __spark_entry__ import entry, oracle_sql, queries
from stratalake.queries import ALL

SF_DIR = "/root/testdata/sf0.001"
TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF_DIR}/{name}.parquet'")
    yield connection
    connection.close()


def comparable(value):
    if isinstance(value, float):
        return None if math.isnan(value) else round(value, 6)
    if isinstance(value, (date, datetime)):
        return value.isoformat()
    return value


def normal(columns, data):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(comparable(row[i]) for i in order) for row in data), key=repr)


def test_every_query_has_sql():
    assert ALL.keys() <= oracle_sql().keys() <= queries().keys()


@pytest.mark.parametrize("name", sorted(ALL))
def test_query_matches_sql(spark, duck, name):
    df = queries()[name](spark, SF_DIR)
    expected = duck.execute(oracle_sql()[name])
    columns = [column[0] for column in expected.description]
    assert sorted(df.columns) == sorted(columns)
    expected_rows = normal(columns, expected.fetchall())
    assert normal(df.columns, df.collect()) == expected_rows
    assert expected_rows


def test_entry(spark):
    assert entry(spark).columns == [
        "_PurchaseOrderNumber",
        "Total_Price",
        "Total_Items_Ordered",
    ]
