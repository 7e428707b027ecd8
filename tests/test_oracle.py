"""Every registered query against its SQL on the smallest tables."""

import os

import pytest

import __spark_entry__ as entry
from compare import compare, duck
from precinct.catalog.queries import QUERIES

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def con():
    return duck(SF)


def test_every_query_has_sql():
    assert set(QUERIES) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, name):
    ok, what = compare(spark, con, name, SF, entry.oracle_sql().get(name))
    assert ok, what


def test_entry(spark):
    assert entry.entry(spark).count() > 0
