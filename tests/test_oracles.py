"""Every registered query beside its SQL on the same tables."""

import pytest
from oracle_check import compare, connect

from registry import ORACLES, QUERIES


@pytest.fixture(scope="module")
def con(sf):
    return connect(sf)


def test_every_query_has_sql():
    assert set(ORACLES) == set(QUERIES)


SIDE_EFFECTS = ("s0", "s1", "e0", "k13", "k14", "k15")  # these write tables while they build


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_equals_sql_and_stays_on_the_jvm(spark, sf, con, name):
    df = QUERIES[name](spark, sf)
    assert compare(df, con, ORACLES[name]) is None
    if name.startswith(SIDE_EFFECTS):
        return
    plan = df._jdf.queryExecution().executedPlan().toString()
    for banned in ("Python", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert banned not in plan
