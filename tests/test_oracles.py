"""Every registered query against its SQL, on the smallest test tables."""

import os

import pytest

import __spark_entry__ as entry
from tests.oracle import connect, difference

FOLDER = entry.SMOKE_DIR
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables")
QUERIES, ORACLES = entry.queries(), entry.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return connect(FOLDER)


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(QUERIES)
    plain = {n for n in QUERIES if not n.startswith("op") and n != "pipeline"}
    assert plain <= set(ORACLES)


def test_entry(spark):
    assert entry.entry(spark).count() > 0


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_its_sql(spark, con, name):
    assert difference(QUERIES[name](spark, FOLDER), con, ORACLES[name]) is None
