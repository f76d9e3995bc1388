"""Queries with a SQL twin, against DuckDB on the smallest tables; and the contract's columns."""

import pytest

from strata.llm.oracle_sql import ORACLE
from strata.llm.queries import QUERIES
from tests.oracle import compare, duck


@pytest.mark.parametrize("key", sorted(ORACLE))
def test_query_matches_sql(spark, sf_small, key):
    res = compare(spark, QUERIES[key], ORACLE[key], sf_small, duck(sf_small), exact=True)
    assert res["values_match"], res


def test_one_query_for_each_operator():
    assert sorted(int(k[2:].split("_")[0]) for k in QUERIES) == list(range(1, 14))
