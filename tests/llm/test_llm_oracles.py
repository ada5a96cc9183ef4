"""Queries with SQL against it, whole tables."""

import pytest

from oracle_harness import compare
from wapspark.llm.registry import ORACLE_SQL, QUERIES


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_query_matches_sql(spark, name):
    r = compare(spark, "/root/testdata/sf0.001", name, QUERIES[name], ORACLE_SQL[name])
    assert r["status"] == "MATCH", r
