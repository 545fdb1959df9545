"""Every registered query over the small tables equals its SQL counterpart."""

from __future__ import annotations

import pytest

import __spark_entry__ as registered
import compare
from tradewind.plans import oracle, registry

FOLDER = "/root/testdata/sf0.001"
QUERIES = registry.queries()
ORACLE = oracle.oracle_sql()


@pytest.fixture(scope="module")
def sql():
    return compare.connect(FOLDER)


def test_every_answer_belongs_to_a_query():
    assert set(ORACLE) == set(QUERIES)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_sql(spark, sql, name):
    df = QUERIES[name](spark, FOLDER)
    expected = sql.execute(ORACLE[name])
    columns = [c[0] for c in expected.description]
    assert sorted(df.columns) == sorted(columns)
    assert compare.ordered(df.collect(), df.columns) == compare.ordered(expected.fetchall(), columns)


def test_fitted_model_passes_the_gate(spark):
    row = QUERIES["ml_metrics"](spark, FOLDER).first()
    assert row.n_rows > 100 and row.passed


def test_entry(spark):
    assert registered.entry(spark).count() > 0


def test_integration_bounds(spark):
    features = QUERIES["mart_order_features"](spark, FOLDER)
    assert features.count() > 1000
    assert features.select("order_id").distinct().count() == features.count()
    days = QUERIES["mart_daily_order_anomalies"](spark, FOLDER)
    assert days.count() > 300
    assert 0 < days.where("is_anomaly = 1").count() < days.count()
