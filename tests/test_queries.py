"""Every registered query against its SQL on the smallest test data."""

import os

import duckdb
import pytest

import check
import __spark_entry__ as spark_entry
from evalspark.plans.catalog import QUERIES

SF_DIR = "/root/testdata/sf0.001"
JOBS, ORACLE = QUERIES, spark_entry.oracle_sql()

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test data")


@pytest.fixture(scope="module")
def base():
    connection = duckdb.connect()
    for name in check.TABLES:
        connection.execute(f"create view {name} as select * from '{SF_DIR}/{name}.parquet'")
    return connection


def test_every_query_has_its_sql():
    assert set(JOBS) <= set(ORACLE)


@pytest.mark.parametrize("name", JOBS)
def test_query_agrees_with_sql(spark, base, name):
    df = JOBS[name](spark, SF_DIR)
    cursor = base.execute(ORACLE[name])
    theirs = check.table([d[0] for d in cursor.description], cursor.fetchall())
    assert check.table(df.columns, df.collect()) == theirs


def test_entry(spark):
    assert spark_entry.entry(spark).count() == 4
