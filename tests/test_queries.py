"""Every registered query against its SQL, on the smallest tables."""

import os
import sys

import duckdb
import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))

import __spark_entry__ as entry_module  # noqa: E402
from check import spark_rows, sql_rows  # noqa: E402

from tripweave.plans.oracles import TABLES  # noqa: E402

SF_DIR = "/root/testdata/sf0.001"
QUERIES = entry_module.queries()
ORACLES = entry_module.oracle_sql()


@pytest.fixture(scope="module")
def connection():
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF_DIR}/{name}.parquet'")
    return connection


@pytest.mark.parametrize("name", [name for name in QUERIES if name in ORACLES])
def test_query_matches_sql(spark, connection, name):
    ours = spark_rows(QUERIES[name](spark, SF_DIR))
    theirs = sql_rows(connection, ORACLES[name])
    assert ours[0] == theirs[0]
    assert ours[1] == theirs[1]
    assert sum(ours[1].values()) > 0


def test_every_sql_has_a_query():
    assert set(ORACLES) <= set(QUERIES)


def test_entry(spark):
    assert entry_module.entry(spark).count() > 0
