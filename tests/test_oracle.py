"""Every registered query against its DuckDB oracle on the smallest tables."""

import pytest

import __spark_entry__ as E
from jobtide import plans
from oracle_check import compare, duck_connect

SF = "/root/testdata/sf0.001"
SQL = plans.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return duck_connect(SF)


def test_every_query_has_an_oracle():
    assert set(plans.queries()) == set(SQL)
    assert set(SQL) <= set(E.queries())


@pytest.mark.parametrize("name", sorted(SQL))
def test_matches_oracle(spark, con, name):
    r = compare(spark, con, name, SF, E.queries()[name], SQL[name])
    assert r["status"] == "ok", r


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns == ["category", "unit", "postings", "with_salary", "avg_salary"]
    assert df.count() > 0
