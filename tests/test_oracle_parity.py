"""Every registered query against its independent DuckDB statement (sf0.001)."""

import pytest

import __spark_entry__ as E
from lessonlens.plans.catalog import QUERIES
from oracle.compare import compare
from oracle.queries_sql import ORACLE
from tests.conftest import SF_SMALL


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLE)
    assert set(QUERIES) <= set(E.queries()) and set(ORACLE) <= set(E.oracle_sql())


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0 and "user_id" in df.columns


@pytest.mark.parametrize("key", sorted(QUERIES))
def test_query_matches_oracle(spark, duck_small, key):
    res = compare(QUERIES[key](spark, SF_SMALL), duck_small, ORACLE[key])
    assert res["cols_match"], res
    assert res["rows_match"] and res["values_match"], res
