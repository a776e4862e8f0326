import os

import pytest

import __spark_entry__ as entry
from oreworks.catalogue import queries as registered
from tests.compare import assert_same, duck

SF_DIR = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def con():
    return duck(SF_DIR)


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_query_matches_sql(spark, con, name):
    assert_same(entry.queries()[name](spark, SF_DIR), con, entry.oracle_sql()[name])


def test_every_table_query_has_an_oracle():
    assert set(registered.queries()) <= set(entry.oracle_sql()) <= set(entry.queries())


def test_entry(spark):
    assert entry.entry(spark).count() > 0
