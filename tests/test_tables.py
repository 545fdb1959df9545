"""Tables of the hand-made marketplace, branch by branch."""

from __future__ import annotations

import math

import pytest
from fixtures import raw_tables

from tradewind.config import AnomalySettings, Settings
from tradewind.operators import marts, staging
from tradewind.plans.warehouse import DATASETS, Warehouse


@pytest.fixture(scope="module")
def house(spark, tmp_path_factory):
    return Warehouse(spark, raw_tables(spark), folder=str(tmp_path_factory.mktemp("house")))


@pytest.fixture(scope="module")
def rows(house):
    cache = {}

    def by_key(name, *keys):
        if name not in cache:
            cache[name] = house.table(name).collect()
        return {(r[keys[0]] if len(keys) == 1 else tuple(r[k] for k in keys)): r for r in cache[name]}

    return by_key


def test_order_flags_keep_unknown_apart_from_on_time(rows):
    orders = rows("stg_orders", "order_id")
    late = {k: r.is_late_delivery for k, r in orders.items()}
    assert (late["late"], late["early"], late["same_day"], late["in_transit"]) == (1, 0, 0, None)
    assert late["no_estimate"] == 0  # delivered, but nothing to be late against
    assert [orders[k].is_delivered for k in ("late", "in_transit")] == [1, 0]
    assert [orders[k].is_canceled for k in ("canceled", "no_items", "late", "no_status")] == [1, 1, 0, 0]


def test_day_differences_count_midnights(rows):
    early = rows("stg_orders", "order_id")["early"]
    assert early.delivery_days == 3  # 2 days and 10 hours, three midnights
    assert early.delivery_delay_days == -5
    assert (early.order_hour, early.order_dow) == (23, 2)
    assert rows("stg_orders", "order_id")["no_items"].order_dow == 7  # a Sunday


def test_price_segments_at_their_edges(rows):
    items = rows("stg_order_items", "order_id", "order_item_id")
    segment = {k: r.price_segment for k, r in items.items()}
    assert segment[("late", 1)] == "LOW"
    assert segment[("late", 2)] == "MEDIUM"
    assert segment[("early", 1)] == "HIGH"
    assert segment[("same_day", 1)] == "VERY_HIGH"
    assert segment[("no_status", 1)] == "UNKNOWN"
    assert items[("in_transit", 1)].freight_share is None  # nothing to divide by
    assert items[("no_status", 1)].item_total is None


def test_payments_collapse_to_the_order(rows):
    payments = rows("stg_order_payments", "order_id")
    assert payments["late"].main_payment_type == "boleto"  # tie: the first name
    assert payments["late"].payment_types == "boleto, voucher"
    assert payments["early"].main_payment_type == "credit_card"
    assert (payments["early"].payment_total, payments["early"].max_installments) == (220.0, 8)
    assert payments["same_day"].main_payment_type is None  # no value at all
    assert payments["same_day"].payment_total is None
    assert payments["canceled"].payment_types is None  # only NULL types, not ''
    assert payments["no_estimate"].main_payment_type == "voucher"  # tie with a NULL type


def test_latest_review_wins_and_ties_go_to_the_smaller_id(rows):
    reviews = rows("stg_order_reviews", "order_id")
    assert (reviews["late"].review_id, reviews["late"].is_good_review, reviews["late"].has_comment) == ("r_new", 1, 0)
    assert (reviews["early"].review_id, reviews["early"].is_bad_review, reviews["early"].has_comment) == ("r_a", 1, 1)
    assert (reviews["same_day"].is_bad_review, reviews["same_day"].is_good_review) == (0, 0)


def test_products_without_category_stay(rows):
    products = rows("stg_products", "product_id")
    names = {k: (r.product_category_name, r.product_category_name_english) for k, r in products.items()}
    assert names["p_beauty"] == ("beleza_saude", "health_beauty")
    assert names["p_none"] == ("unknown", "unknown")
    assert names["p_game"] == ("pc_gamer", "unknown")
    assert names["p_heavy"] == ("vazio", "unknown")  # an empty translation
    assert products["p_beauty"].product_volume_cm3 == 60.0
    assert products["p_game"].product_volume_cm3 is None


def test_centroids_ignore_outliers(rows):
    geo = rows("stg_geolocation", "zip_code_prefix")
    assert set(geo) == {1001, 2002, 5005}
    assert geo[1001].latitude == pytest.approx(-23.6)
    assert geo[1001].longitude == pytest.approx(-46.7)
    assert (geo[1001].points_cnt, geo[1001].city, geo[1001].state) == (2, "osasco", "SP")


def haversine(lat1, lon1, lat2, lon2):
    lat1, lon1, lat2, lon2 = map(math.radians, (lat1, lon1, lat2, lon2))
    h = math.sin((lat2 - lat1) / 2) ** 2 + math.cos(lat1) * math.cos(lat2) * math.sin((lon2 - lon1) / 2) ** 2
    return 12742 * math.asin(math.sqrt(h))


def test_distance_is_to_the_nearest_seller(rows):
    distance = {k: r.customer_seller_distance_km for k, r in rows("int_order_distance", "order_id").items()}
    assert distance["late"] == pytest.approx(0)  # two sellers, one next door
    assert distance["early"] == pytest.approx(0)  # the other seller has no centroid
    assert distance["same_day"] == pytest.approx(haversine(-22.9, -43.2, -23.6, -46.7))
    assert distance["canceled"] is None
    assert "in_transit" not in distance and "no_items" not in distance


def test_wide_order_row(rows):
    orders = rows("int_orders_enriched", "order_id")
    assert len(orders) == 8
    bare = orders["no_items"]
    assert (bare.items_cnt, bare.order_value, bare.order_value_segment, bare.is_large_order) == (0, 0.0, "LOW", 0)
    assert (bare.payment_total, bare.review_score, bare.is_bad_review, bare.has_review) == (None, None, None, 0)
    assert bare.customer_seller_distance_km is None
    late = orders["late"]
    assert (late.items_cnt, late.distinct_products_cnt, late.distinct_sellers_cnt) == (2, 1, 2)
    assert late.order_value == pytest.approx(70.0)
    assert orders["early"].is_large_order == 1
    assert orders["same_day"].has_review == 1 and orders["same_day"].review_score is None
    assert orders["no_estimate"].customer_region is None
    assert orders["no_estimate"].is_large_order == 1  # exactly at the threshold


def test_wide_item_row_takes_keys_from_the_dimensions(rows):
    items = rows("int_order_items_enriched", "order_id", "order_item_id")
    assert len(items) == 9
    lost = items[("in_transit", 1)]
    assert (lost.product_id, lost.seller_id, lost.product_category_name_english) == (None, None, None)
    assert items[("canceled", 1)].seller_region is None
    assert items[("late", 1)].seller_region == "Sudeste"


def test_daily_state_metrics(rows):
    days = rows("mart_daily_state_metrics", "order_purchase_date", "customer_state")
    by_state = {(str(d), s): r for (d, s), r in days.items()}
    rj = by_state[("2018-01-01", "RJ")]
    assert (rj.orders_cnt, rj.unique_customers, rj.delivered_cnt) == (2, 1, 1)
    assert rj.total_revenue == pytest.approx(330.0)
    assert rj.p95_order_value == pytest.approx(313.5)
    assert rj.late_delivery_rate == 0.0
    am = by_state[("2018-01-06", "AM")]
    assert am.late_delivery_rate is None and am.bad_review_rate is None


def test_category_mart_keeps_the_null_category(rows):
    categories = rows("mart_delivery_quality_by_category", "product_category_name_english")
    assert set(categories) == {"health_beauty", "unknown", None}
    assert categories[None].items_cnt == 1 and categories[None].sellers_cnt == 0
    beauty = categories["health_beauty"]
    assert (beauty.items_cnt, beauty.orders_cnt, beauty.sellers_cnt) == (4, 3, 3)
    assert beauty.late_delivery_rate == pytest.approx(66.67)


def test_hourly_pattern_names_days(rows):
    pattern = rows("mart_hourly_order_pattern", "order_dow", "order_hour")
    assert pattern[(6, 0)].dow_name == "Суббота" and pattern[(6, 0)].is_weekend == 1
    assert pattern[(6, 0)].cancel_rate == 100.0
    assert pattern[(1, 10)].dow_name == "Понедельник" and pattern[(1, 10)].orders_cnt == 5


def test_customer_profile_is_per_person(rows):
    people = rows("mart_customer_value_profile", "customer_unique_id")
    assert len(people) == 4
    assert people["ann"].is_repeat_customer == 1 and people["ann"].late_orders_cnt == 1
    assert people["ann"].recency_days == 5
    assert people["cid"].recency_days == 0
    assert people["ann"].value_segment == "MEDIUM"
    assert people["cid"].value_segment == "LOW"


def test_customer_segment_edges(frame):
    orders = frame(
        "customer_unique_id string, customer_state string, customer_region string, order_value double,"
        " order_purchase_date date, is_late_delivery int, is_bad_review int, is_canceled int, has_review int,"
        " review_score int",
        *[(str(v), "SP", "x", v, None, None, None, 0, 0, None) for v in (149.99, 150.0, 499.99, 500.0)],
    )
    got = {r.customer_unique_id: r.value_segment for r in marts.mart_customer_value_profile(orders).collect()}
    assert got == {"149.99": "LOW", "150.0": "MEDIUM", "499.99": "MEDIUM", "500.0": "HIGH"}


def test_seller_with_too_few_orders_is_not_flagged(frame):
    schema = (
        "seller_id string, seller_state string, seller_city string, seller_region string, order_id string,"
        " product_id string, product_category_name_english string, customer_state string, item_total double,"
        " price double, freight_value double, is_delivered int, is_late_delivery int, delivery_days int,"
        " has_review int, is_bad_review int, review_score int, customer_seller_distance_km double"
    )

    def sold(seller, n):
        fixed = ("SP", 1.0, 1.0, 0.0, 1, 1, 3, 0, None, None, None)
        return [(seller, "SP", "x", "r", f"{seller}{i}", "p", "b" if i else "a", *fixed) for i in range(n)]

    items = frame(schema, *sold("nine", 9), *sold("ten", 10))
    got = {r.seller_id: r for r in marts.mart_seller_analytics(items).collect()}
    assert (got["nine"].is_underperforming, got["ten"].is_underperforming) == (0, 1)
    assert (got["ten"].categories, got["ten"].unique_categories) == ("a, b", 2)
    assert got["ten"].bad_review_rate is None


def test_seller_mart_keeps_the_null_seller(rows):
    sellers = rows("mart_seller_analytics", "seller_id")
    assert set(sellers) == {"s_near", "s_far", "s_lost", None}
    assert sellers[None].categories is None and sellers[None].unique_categories == 0
    assert sellers["s_near"].states_served == 3


def test_features(rows):
    features = rows("mart_order_features", "order_id")
    assert len(features) == 8
    assert features["early"].main_product_category == "health_beauty"  # tie in value: the first name
    assert features["early"].total_weight_g == 600.0 and features["early"].max_item_weight_g == 500.0
    bare = features["no_items"]
    assert (bare.freight_share, bare.main_payment_type, bare.max_installments) == (None, "unknown", 0)
    assert (bare.main_product_category, bare.total_weight_g) == ("unknown", 0.0)
    assert features["in_transit"].is_late_delivery is None
    assert features["in_transit"].main_product_category == "unknown"
    assert features["late"].estimated_delivery_span_days == 9
    assert features["late"].purchase_month == 1


def test_purchase_window_is_half_open(spark):
    orders = raw_tables(spark)["orders"]
    kept = staging.stg_orders(orders, Settings(start_date="2018-01-01 10:00:00", end_date="2018-01-06"))
    assert kept.where("order_id = 'late'").count() == 1
    assert kept.where("order_id = 'canceled'").count() == 0
    assert staging.stg_orders(orders, Settings(start_date="2018-01-06")).count() == 8  # one bound: no filter


def test_grace_days(spark):
    got = staging.stg_orders(raw_tables(spark)["orders"], Settings(late_delivery_grace_days=1))
    assert got.where("order_id = 'late'").first().is_late_delivery == 0


def _days(frame, counts):
    from datetime import date

    rows = [(f"{d}-{i}", date.fromisoformat(d), int(i == 0)) for d, n in counts.items() for i in range(n)]
    return frame("order_id string, order_purchase_date date, is_canceled int", *rows)


def test_spike_is_flagged_and_gaps_are_filled(frame):
    counts = {"2018-01-01": 10, "2018-01-02": 11, "2018-01-03": 9, "2018-01-04": 10, "2018-01-06": 60}
    got = {
        str(r.order_date): r
        for r in marts.mart_daily_order_anomalies(_days(frame, counts), AnomalySettings(3, 3.0)).collect()
    }
    assert len(got) == 6
    assert got["2018-01-05"].orders_cnt == 0 and got["2018-01-05"].canceled_cnt == 0
    assert all(got[f"2018-01-0{d}"].rolling_mean is None for d in (1, 2, 3))
    assert (got["2018-01-06"].is_anomaly, got["2018-01-06"].anomaly_direction) == (1, "spike")
    assert all(got[f"2018-01-0{d}"].is_anomaly == 0 for d in (1, 2, 3, 4))


def test_constant_series_has_no_score(frame):
    counts = {f"2018-02-0{d}": 5 for d in range(1, 8)}
    got = marts.mart_daily_order_anomalies(_days(frame, counts), AnomalySettings(3, 3.0)).collect()
    assert all(r.z_score is None and r.is_anomaly == 0 and r.anomaly_direction is None for r in got)


def test_anomaly_settings_have_no_defaults():
    with pytest.raises(TypeError):
        AnomalySettings(anomaly_z_threshold=3)


def test_build_writes_every_table_once(spark, tmp_path):
    house = Warehouse(spark, raw_tables(spark), folder=str(tmp_path))
    built = house.build()
    assert set(built) == set(DATASETS)
    for name, layer in (("stg_orders", "staging"), ("int_order_distance", "intermediate"), ("mart_order_features", "marts")):
        assert (tmp_path / layer / name / "_SUCCESS").exists()
    assert (tmp_path / "marts" / "mart_daily_state_metrics" / "purchase_ym=201801").exists()
    assert built["int_orders_enriched"].count() == built["stg_orders"].count() == 8
