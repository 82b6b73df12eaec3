"""Every registered query against its SQL twin, and the shape of its plan."""

import os

import pytest

import __spark_entry__ as entry
from checks.compare import database, difference
from checks.registry import REGISTRY

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
QUERIES, SQL = REGISTRY.queries, REGISTRY.sql
FORBIDDEN = ["BroadcastNestedLoopJoin", "CartesianProduct", "BatchEvalPython", "ArrowEvalPython"]

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables")


@pytest.fixture(scope="module")
def con():
    return database(SF_DIR)


def test_every_query_has_a_twin():
    assert set(QUERIES) == set(SQL)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, plan, name):
    df = QUERIES[name](spark, SF_DIR)
    assert not [node for node in FORBIDDEN if node in plan(df)]
    assert difference(df, con, SQL[name]) is None


def test_entry(spark):
    assert entry.entry(spark).columns == [
        "weight_class", "stance", "opp_stance", "fights", "wins", "win_rate"
    ]
