"""Every registered query against its SQL on whole tables."""

import pytest

from compare import difference, oracle_connection, oracle_result, spark_result
from delaynet.plans.catalog import ORACLES, QUERIES

ROWS_ONLY = {"approx_top_keys"}


@pytest.fixture(scope="module")
def oracle(sf_dir):
    return oracle_connection(sf_dir)


def test_every_query_has_its_sql():
    assert set(QUERIES) - set(ORACLES) == ROWS_ONLY
    assert set(ORACLES) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, sf_dir, oracle, name):
    problem = difference(spark_result(QUERIES[name](spark, sf_dir)), oracle_result(oracle, ORACLES[name]))
    assert problem is None, problem


def test_rows_only_queries(spark, sf_dir):
    top = QUERIES["approx_top_keys"](spark, sf_dir).collect()
    exact = {r.tail_number: r.n for r in QUERIES["top_keys"](spark, sf_dir).collect()}
    assert top and all(exact[r.tail_number] == r.n for r in top)
