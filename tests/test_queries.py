"""Every query with SQL against it over the smallest tables; the others run and have rows."""

import pytest

import __spark_entry__ as entry

from .oracle import compare

SQL = {k: v for k, v in entry.oracle_sql().items() if entry.queries()[k].__module__.startswith("evigraph.plans")}
OTHERS = sorted(k for k, f in entry.queries().items() if k not in SQL and f.__module__.startswith("evigraph.plans"))


def test_names():
    assert set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(SQL))
def test_against_sql(spark, small, name):
    assert compare(spark, name, entry.queries()[name], SQL[name], small) == ""


@pytest.mark.parametrize("name", OTHERS)
def test_runs(spark, small, name):
    df = entry.queries()[name](spark, small)
    assert df.columns and df.count() >= 0


def test_entry(spark):
    assert entry.entry(spark).columns[:2] == ["node_id", "node_type"]
