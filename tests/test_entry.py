"""The driver contract in __spark_entry__.py."""

import importlib

entry_mod = importlib.import_module("__spark_entry__")


def test_entry_runs_with_stable_schema(spark):
    df = entry_mod.entry(spark)
    assert df.count() > 0
    assert df.columns == list(entry_mod.entry(spark).columns)


def test_every_catalogue_query_has_sql():
    q, sql = entry_mod.queries(), entry_mod.oracle_sql()
    assert q and set(sql) <= set(q)
    assert {k for k in q if k != "pipeline" and not k.startswith("op")} <= set(sql)
