"""Every query of the suite against its SQL counterpart."""

import os

import pytest

import __spark_entry__ as entry_points
from suite.oracle import ORACLE
from suite.queries import REGISTRY
from tests.compare import connect, difference

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="test tables not present")


@pytest.fixture(scope="module")
def connection():
    return connect(SF_DIR)


def test_every_query_has_sql():
    assert set(REGISTRY) == set(ORACLE)
    assert set(REGISTRY) <= set(entry_points.queries()) and set(ORACLE) <= set(entry_points.oracle_sql())


@pytest.mark.parametrize("name", REGISTRY)
def test_query(spark, connection, name):
    assert difference(REGISTRY[name](spark, SF_DIR), connection, ORACLE[name]) is None


def test_entry(spark):
    got = entry_points.entry(spark)
    assert got.columns == ["source", "row_key", "text", "row_hash"] and not got.isEmpty()
