"""Every registered query against its SQL, on the smallest data set."""

from pathlib import Path

import pytest

import __spark_entry__ as contract
from check import connect, differences
from millrace.registry.oracle import ORACLE
from millrace.registry.queries import QUERIES

SF_DIR = "/root/testdata/sf0.001"

pytestmark = pytest.mark.skipif(not Path(SF_DIR).exists(), reason="needs the test tables")


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


def test_every_query_has_its_sql():
    assert set(QUERIES) == set(ORACLE)
    assert set(QUERIES) <= set(contract.queries())


@pytest.mark.parametrize("key", QUERIES)
def test_agrees_with_sql(spark, con, key):
    assert differences(spark, con, key, SF_DIR) is None


def test_entry(spark):
    assert contract.entry(spark).count() > 0
