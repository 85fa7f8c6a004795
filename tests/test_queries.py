"""Every registered query against its SQL oracle on the smallest data set."""

from pathlib import Path

import pytest

from verification.compare import oracle_connection, oracle_rows, spark_rows
from verification.oracles import ORACLES
from verification.queries import QUERIES

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(FOLDER).is_dir(), reason="needs the test tables")


@pytest.fixture(scope="module")
def connection():
    return oracle_connection(FOLDER)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, connection, name):
    result = QUERIES[name](spark, FOLDER)
    assert spark_rows(result) == oracle_rows(connection, ORACLES[name])
    plan = result._jdf.queryExecution().executedPlan().toString()
    for slow in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython"):
        assert slow not in plan


def test_every_query_has_an_oracle():
    assert QUERIES.keys() == ORACLES.keys()


def test_entry_point(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).count() > 0
    assert entry.queries().keys() >= entry.oracle_sql().keys()
    assert entry.queries().keys() >= QUERIES.keys()
