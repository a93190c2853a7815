"""Every registered query against its SQL, and the shape of every plan."""

import check_oracle
import pytest
from conftest import SMALL, plan_of

import __spark_entry__ as contract
from aisflow.plans import oracle, queries

QUERIES = queries.REGISTERED


@pytest.fixture(scope="module")
def connection():
    return check_oracle.connect(SMALL)


def test_every_query_has_sql():
    assert set(QUERIES) == set(oracle.SQL)
    assert set(QUERIES) <= set(contract.queries())


@pytest.mark.parametrize("name", QUERIES)
def test_query_agrees_with_sql(spark, connection, name):
    frame = QUERIES[name](spark, SMALL)
    plan = plan_of(frame)
    assert "Cartesian" not in plan and "NestedLoop" not in plan
    assert "Python" not in plan or name == "zip_roundtrip"
    ours = frame.toPandas()
    theirs = connection.execute(contract.oracle_sql()[name]).df()
    assert check_oracle.difference(ours, theirs) is None
    assert len(ours)


def test_entry(spark):
    assert contract.entry(spark).count() > 1000
