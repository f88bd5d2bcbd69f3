"""Queries with SQL, on whole tables."""

import pytest

from lendspark.llm.registry import oracle_sql, queries
from tests_llm_helpers import same_as_sql


@pytest.mark.parametrize("name", sorted(oracle_sql()))
def test_query_equals_sql(spark, name):
    rows = same_as_sql(spark, queries()[name], oracle_sql()[name])
    assert rows


def test_one_query_per_operator():
    assert sorted(int(n[2:].split("_")[0]) for n in queries()) == list(range(1, 14))
