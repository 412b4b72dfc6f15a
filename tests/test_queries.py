"""Every query against its SQL oracle on the smallest tables."""

import pytest

import compare
from __spark_entry__ import entry, oracle_sql, queries

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def db():
    return compare.database(FOLDER)


@pytest.mark.parametrize("name", sorted(queries()))
def test_query(spark, db, name):
    ok, note = compare.compare(spark, db, FOLDER, name)
    assert ok, note


def test_entry(spark):
    assert entry(spark).count() == 1500


def test_oracles_belong_to_queries():
    assert set(oracle_sql()) <= set(queries())
