"""Every catalogue key against its DuckDB twin, on the smallest test tables."""

import pytest

from strata.plans.oracle_sql import ORACLE
from strata.plans.queries import QUERIES
from tests.oracle import compare, duck

KEYS = sorted(QUERIES)


@pytest.fixture(scope="module")
def con(sf_small):
    return duck(sf_small)


def test_every_query_has_an_oracle():
    assert set(ORACLE) >= set(QUERIES)


@pytest.mark.parametrize("key", KEYS)
def test_query_matches_oracle(spark, sf_small, con, key):
    res = compare(spark, QUERIES[key], ORACLE[key], sf_small, con)
    assert res["values_match"], res


SPARK_TO_DUCK = {"int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE", "string": "VARCHAR", "date": "DATE",
                 "boolean": "BOOLEAN"}


@pytest.mark.parametrize("key", KEYS)
def test_column_types_match_oracle(spark, sf_small, con, key):
    got = {f.name.lower(): SPARK_TO_DUCK.get(f.dataType.simpleString(), f.dataType.simpleString())
           for f in QUERIES[key](spark, sf_small).schema.fields}
    rel = con.sql(ORACLE[key])
    want = {n.lower(): str(t) for n, t in zip(rel.columns, rel.types)}
    assert got == want
