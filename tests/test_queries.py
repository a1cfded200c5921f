"""Every registered query against its SQL in another engine, on the smallest tables."""

import os

import duckdb
import pytest

import __spark_entry__ as contract
from stratagauge.plans import catalog, oracle

DATA = "/root/testdata/sf0.001"
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark"
    " labels conversations"
).split()

pytestmark = pytest.mark.skipif(not os.path.isdir(DATA), reason="test tables are not here")


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for table in TABLES:
        connection.sql(f"create view {table} as select * from '{DATA}/{table}.parquet'")
    return connection


def normalized(columns, values):
    order = sorted(range(len(columns)), key=columns.__getitem__)
    return [columns[i] for i in order], sorted(
        [tuple(repr(v) if isinstance(v, float) else str(v) for v in (row[i] for i in order)) for row in values]
    )


def test_every_query_has_sql():
    assert set(catalog.QUERIES) == set(oracle.SQL)


@pytest.mark.parametrize("name", sorted(contract.oracle_sql()))
def test_query_matches_sql(spark, duck, name):
    df = contract.queries()[name](spark, DATA)
    expected = duck.sql(contract.oracle_sql()[name])
    ours = normalized(df.columns, [tuple(r) for r in df.collect()])
    assert ours == normalized(expected.columns, expected.fetchall())


def test_entry_is_the_flagship_query(spark):
    df = contract.entry(spark)
    assert df.columns == ["territory_id", "yr", "network", "grade", "rate", "target_value", "gap_pp", "attained"]
    assert df.count() == 420
