"""All registered queries beside their SQL, on the smallest tables."""

import os

import duckdb
import pytest

import __spark_entry__ as contract
from registrylake.workloads.registry import QUERIES, SQL

SF = "/root/testdata/sf0.001"
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()

pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="given tables are not here")


@pytest.fixture(scope="module")
def db():
    connection = duckdb.connect()
    for t in TABLES:
        connection.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return connection


def ordered(columns, rows):
    at = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(row[i] for i in at) for row in rows), key=repr)


@pytest.mark.parametrize("name", contract.queries())
def test_query(spark, db, name):
    df = contract.queries()[name](spark, SF)
    got = [tuple(r) for r in df.collect()]
    if name not in contract.oracle_sql():
        return
    result = db.execute(contract.oracle_sql()[name])
    columns = [d[0] for d in result.description]
    assert sorted(columns) == sorted(df.columns)
    assert ordered(df.columns, got) == ordered(columns, result.fetchall())


def test_every_query_has_sql():
    """Those of the library itself; some training-data operators are beyond SQL and have tests of their own."""
    assert set(SQL) == set(QUERIES) and set(SQL) <= set(contract.oracle_sql()) <= set(contract.queries())


def test_entry(spark):
    assert contract.entry(spark).count() > 0
