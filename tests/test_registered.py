"""Every registered query against its SQL twin."""

import functools

import pytest
from compare import database, difference, registered
from test_plans import plan

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return database(FOLDER)


@pytest.fixture(scope="module", autouse=True)
def shared_lakes():
    """Queries that ask the same stored tables have them made once here."""
    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(registered, "_corrected", functools.cache(registered._corrected))
        yield


OWN = [query.__name__ for query in registered._QUERIES]


def test_every_query_has_a_twin():
    assert set(OWN) <= registered.oracle_sql().keys()


def stays_in_the_jvm(df):
    text = plan(df)
    for operator in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython", "InPandas"):
        assert operator not in text, "a query multiplies rows or leaves the JVM"


@pytest.mark.parametrize("name", OWN)
def test_query_equals_sql(spark, con, name):
    assert difference(spark, con, FOLDER, name, stays_in_the_jvm) is None


def test_entry(spark):
    df = registered.entry(spark)
    assert df.columns[:2] == ["date", "store_region"] and df.count() > 0
