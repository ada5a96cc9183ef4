"""Every registered query against its DuckDB oracle (sf0.001), and the
driver's smoke entry."""

import pytest

import __spark_entry__ as E
from oracle_harness import compare
from wapspark.plans.oracle_registry import ORACLE_SQL as SQL
from wapspark.plans.registry import QUERIES

from conftest import SF_SMALL


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, name):
    r = compare(spark, SF_SMALL, name, QUERIES[name], SQL.get(name))
    assert r["status"] in ("MATCH", "rows-only"), r


def test_every_query_has_oracle():
    assert set(QUERIES) == set(SQL)
    assert set(QUERIES) <= set(E.queries()) and set(SQL) <= set(E.oracle_sql())


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert df.columns[:3] == ["transaction_id", "user_id", "product_category"]
