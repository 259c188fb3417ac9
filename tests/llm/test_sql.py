"""Queries against their SQL on the smallest tables."""

import pytest
from checks.compare import compare, connect

from loadshift.llm import catalog, oracles


@pytest.mark.parametrize("name", sorted(oracles.SQL))
def test_query_equals_sql(spark, sf, name):
    assert compare(catalog.QUERIES[name](spark, sf), connect(sf), oracles.SQL[name]) == "ok"


def test_one_query_for_each_operator():
    numbers = [int(n.split("_")[0][2:]) for n in catalog.QUERIES]
    assert sorted(numbers) == list(range(1, 14)) and set(oracles.SQL) <= set(catalog.QUERIES)
