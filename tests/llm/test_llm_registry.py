"""The registered training-data queries against their SQL counterparts."""

from __future__ import annotations

import compare
import pytest

import __spark_entry__ as registered
from tradewind.llm import registry


def test_one_query_for_each_operator():
    numbers = sorted(int(name[2:].split("_")[0]) for name in registry.QUERIES)
    assert numbers == list(range(1, 14))
    assert {*registry.QUERIES, "pipeline"} <= set(registered.queries())
    assert set(registry.ORACLE_SQL) <= set(registered.oracle_sql())


@pytest.mark.parametrize("name", sorted(registry.ORACLE_SQL))
def test_query_equals_sql(spark, sample, name):
    df = registry.QUERIES[name](spark, sample)
    expected = compare.connect(sample).execute(registry.ORACLE_SQL[name])
    columns = [c[0] for c in expected.description]
    assert sorted(df.columns) == sorted(columns)
    assert compare.ordered(df.collect(), df.columns) == compare.ordered(expected.fetchall(), columns)
