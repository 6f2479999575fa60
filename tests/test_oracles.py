"""Every registered query against its SQL, on the smallest tables."""

import duckdb
import pytest

import __spark_entry__ as contract
from airtally.reports.queries import QUERIES
from places import TESTDATA

SF_DIR = f"{TESTDATA}/sf0.001"
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF_DIR}/{table}.parquet'")
    return connection


def comparable(frame):
    frame = frame[sorted(frame.columns)].astype(object)
    frame = frame.where(frame.notna(), None)
    return sorted(map(repr, frame.itertuples(index=False, name=None)))


def test_every_query_has_sql():
    assert set(QUERIES) <= set(contract.queries()) & set(contract.oracle_sql())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(name, spark, duck):
    ours = contract.queries()[name](spark, SF_DIR).toPandas()
    theirs = duck.execute(contract.oracle_sql()[name]).df()
    assert sorted(ours.columns) == sorted(theirs.columns)
    assert comparable(ours) == comparable(theirs)


def test_entry(spark):
    assert contract.entry(spark).count() > 0
