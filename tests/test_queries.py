"""Every registered query against its SQL, on the smallest given tables."""

import pytest

from checks.catalog import REGISTRY
from checks.compare import connect, difference
from checks.oracle import oracle_sql

SQL = oracle_sql()
# no query pairs all rows or leaves the JVM
UNWANTED = ["CartesianProduct", "BroadcastNestedLoopJoin", "Python", "Pandas", "Arrow"]


@pytest.fixture(scope="module")
def con(sf_dir):
    return connect(sf_dir)


def test_every_query_has_sql():
    assert set(REGISTRY) == set(SQL)


@pytest.mark.parametrize("name", list(REGISTRY))
def test_query(spark, con, sf_dir, name):
    df = REGISTRY[name](spark, sf_dir)
    plan = df._jdf.queryExecution().executedPlan().toString()
    for unwanted in UNWANTED:
        assert unwanted not in plan
    assert isinstance(difference(df, con, SQL[name]), int)


def test_entry_contract(spark):
    import __spark_entry__ as contract

    assert contract.entry(spark).columns == ["stage", "rows"]
    named, sql = set(contract.queries()), set(contract.oracle_sql())
    assert set(REGISTRY) <= named and sql <= named
    assert set(REGISTRY) == sql & set(REGISTRY)
