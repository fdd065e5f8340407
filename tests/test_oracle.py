"""Every registered query against its SQL twin, and the plans they run with."""

import pytest

import __spark_entry__ as contract
import oracle


@pytest.fixture(scope="module")
def database(sf_dir):
    return oracle.connect(sf_dir)


@pytest.mark.parametrize("name", sorted(contract.oracle_sql()))
def test_same_rows_as_sql(spark, sf_dir, database, name):
    df = contract.queries()[name](spark, sf_dir)
    assert oracle.differences(df, database, contract.oracle_sql()[name]) == []


@pytest.mark.parametrize("name", sorted(set(contract.queries()) - set(contract.oracle_sql())))
def test_queries_without_sql_give_rows(spark, sf_dir, name):
    assert contract.queries()[name](spark, sf_dir).count() > 0


def test_entry(spark):
    df = contract.entry(spark)
    assert len(df.columns) == 20
    assert df.count() > 0


def test_every_check_has_a_query():
    assert set(contract.oracle_sql()) <= set(contract.queries())
