"""Every registered query against its check SQL, on the smallest tables."""

import pytest
from compare import check, duck

import __spark_entry__ as E

QUERIES, ORACLES = E.queries(), E.oracle_sql()


@pytest.fixture(scope="module")
def con(sf_dir):
    return duck(sf_dir)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_sql(spark, con, sf_dir, name):
    check(spark, con, QUERIES[name], ORACLES[name], sf_dir)


def test_every_sql_has_a_query():
    assert set(ORACLES) <= set(QUERIES)


def test_queries_without_sql_give_rows(spark, sf_dir):
    for name in set(QUERIES) - set(ORACLES):
        assert QUERIES[name](spark, sf_dir).count() > 0


def test_entry(spark):
    assert E.entry(spark).count() == 3
