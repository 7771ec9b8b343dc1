"""Every registered query against its SQL twin, or at least for rows, on the small tables."""

import pytest

import __spark_entry__ as entry
from oracle import compare, connect

PLANS, SQL = entry.queries(), entry.oracle_sql()


@pytest.fixture(scope="module")
def con(sf_dir):
    return connect(sf_dir)


@pytest.mark.parametrize("name", sorted(PLANS))
def test_query(name, spark, sf_dir, con):
    if name in SQL:
        assert compare(spark, con, PLANS[name], SQL[name], sf_dir) is None
    else:
        assert PLANS[name](spark, sf_dir).count() > 0


def test_every_sql_has_a_plan():
    assert set(SQL) <= set(PLANS)


def test_entry_is_stable(spark):
    df = entry.entry(spark)
    assert df.columns[0] == "season" and df.count() > 0
