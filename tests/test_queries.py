"""Every registered query against its SQL twin, over whole tables."""

import os
import sys

import duckdb
import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))

import __spark_entry__ as entry
import verify
from tablewarden.plans.inputs import TABLES

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def connection():
    found = duckdb.connect()
    for table in TABLES:
        found.execute(f"create view {table} as select * from '{SF}/{table}.parquet'")
    return found


@pytest.mark.parametrize("name", list(entry.queries()))
def test_query(name, spark, connection):
    good, message = verify.compare(name, spark, connection, SF)
    assert good and "TYPES" not in message, message


def test_oracles_belong_to_queries():
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_entry(spark):
    assert entry.entry(spark).count() > 0
