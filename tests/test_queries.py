"""Every registered query against its SQL on the small tables."""

import pytest

import __spark_entry__ as contract
from firnspark.plans import catalogue
from tests.compare import compare, connect

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(SF)


@pytest.mark.parametrize("name", sorted(catalogue.QUERIES))
def test_query(spark, con, name):
    statement = contract.oracle_sql().get(name)
    problem = compare(spark, con, name, contract.queries()[name], statement, SF)
    # The quarantined and unscored reports may be empty on few rows, but must agree.
    if problem == "no rows":
        assert statement is not None and con.execute(statement).fetchall() == []
    else:
        assert problem == ""


def test_every_query_has_sql():
    assert set(catalogue.QUERIES) == set(catalogue.ORACLES)
    assert set(catalogue.QUERIES) <= set(contract.queries())


def test_entry(spark):
    df = contract.entry(spark)
    assert len(df.columns) == 142 and df.count() > 0
