"""Marts put together from mergeable partials of the wide tables."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from tradewind.operators import marts, partials
from tradewind.plans.warehouse import Warehouse

MARTS = {
    "mart_daily_state_metrics": ("int_orders_enriched", partials.OrderPartials),
    "mart_delivery_quality_by_state": ("int_orders_enriched", partials.OrderPartials),
    "mart_delivery_quality_by_category": ("int_order_items_enriched", partials.ItemPartials),
}


@pytest.fixture(scope="module")
def house(spark, tmp_path_factory):
    return Warehouse.from_tpch(spark, "/root/testdata/sf0.001", folder=str(tmp_path_factory.mktemp("house")))


def rows(df):
    return sorted((tuple(round(v, 6) if isinstance(v, float) else v for v in r) for r in df.collect()), key=str)


@pytest.mark.parametrize("name", MARTS)
def test_partials_of_two_halves_merge_into_those_of_all(house, name):
    wide, kind = MARTS[name]
    df = house.table(wide)
    half = F.col("order_id") % 2 == 0
    both = partials.combined(kind.of(df.where(half)), kind.of(df.where(~half)))
    assert rows(getattr(marts, name)(None, both)) == rows(getattr(marts, name)(df))


@pytest.mark.parametrize("name", MARTS)
def test_marts_read_written_partials_only(house, name):
    wide, _ = MARTS[name]
    text = house.define(name)._jdf.queryExecution().optimizedPlan().toString()
    files = {f for f in house.define(name).inputFiles()}
    assert files and not any(f"/{wide}/" in f for f in files) and all(f"/{wide}_" in f for f in files)
    assert "Join LeftOuter" not in text


def test_partials_are_shared_between_marts(house):
    first = house._partials(partials.OrderPartials, "int_orders_enriched")
    assert house._partials(partials.OrderPartials, "int_orders_enriched") is first


def test_empty_and_null_groups(spark):
    schema = (
        "order_purchase_date date, customer_state string, customer_region string, customer_unique_id string, order_value double,"
        " freight_value double, distinct_sellers_cnt int, is_large_order int, is_delivered int, is_late_delivery int,"
        " has_review int, is_bad_review int, delivery_days int, review_score int, customer_seller_distance_km double"
    )
    empty = spark.createDataFrame([], schema)
    assert marts.mart_daily_state_metrics(empty).count() == marts.mart_delivery_quality_by_state(empty).count() == 0
    row = (None, None, None, None, None, None, None, 0, 0, None, 0, None, None, None, None)
    got = marts.mart_delivery_quality_by_state(spark.createDataFrame([row, row], schema)).collect()
    assert len(got) == 1 and (got[0].customer_state, got[0].orders_cnt, got[0].unique_customers) == (None, 2, 0)
    assert got[0].late_delivery_rate is got[0].p95_delivery_days is got[0].avg_order_value is None
