"""Every registered query against its SQL, on the smallest tables."""

import pytest

from __spark_entry__ import entry
from tandem.catalog import ORACLES, QUERIES
from tests.oracle import connect, difference

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def connection():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", QUERIES)
def test_query_matches_its_sql(spark, connection, name):
    df = QUERIES[name](spark, SF_DIR)
    assert difference(df, connection, ORACLES[name]) is None
    executed = df._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in executed and "BroadcastNestedLoopJoin" not in executed


def test_every_query_has_sql():
    assert QUERIES.keys() == ORACLES.keys()


def test_entry(spark):
    assert entry(spark).count() == 6
