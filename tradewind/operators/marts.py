"""Marts: one aggregation each over the wide order or item table, plus features and anomalies."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tradewind.config import AnomalySettings, Settings
from tradewind.functions.expressions import (
    UNKNOWN,
    avg_money,
    count_if,
    day_diff,
    flag,
    month_of,
    pct,
    safe_div,
    string_agg_distinct,
    weekday_name,
)
from tradewind.functions.grouping import collapse, group_metrics, merge_groups
from tradewind.functions.ranking import percentiles_of_counts
from tradewind.functions.series import deviations, fill_days, rolling
from tradewind.functions.skew import split_keys
from tradewind.operators.partials import ItemPartials, OrderPartials, mean, mean_money, merged, share


def _rows() -> Column:
    return F.count(F.lit(1))


def _is(name: str) -> Column:
    return count_if(F.col(name) == 1)


def _late_rate() -> Column:
    """Of delivered rows only; undelivered ones would understate it."""
    return pct(_is("is_late_delivery"), _is("is_delivered")).alias("late_delivery_rate")


def _bad_review_rate() -> Column:
    """Of reviewed rows only."""
    return pct(_is("is_bad_review"), _is("has_review")).alias("bad_review_rate")


def mart_daily_state_metrics(orders: DataFrame, partials: OrderPartials | None = None) -> DataFrame:
    keys = ["order_purchase_date", "customer_state"]
    p = partials or OrderPartials.of(orders)
    parts = [
        merged(p.days, keys, {"customer_region": "customer_region"}),
        p.customers.groupBy(*keys).agg(F.count("customer_unique_id").alias("unique_customers")),
        percentiles_of_counts(p.values, keys, {"p95_order_value": 0.95}),
    ]
    return merge_groups(parts, keys).select(
        *keys,
        "customer_region",
        F.col("rows_cnt").alias("orders_cnt"),
        "unique_customers",
        F.col("revenue").alias("total_revenue"),
        mean_money("order_value").alias("avg_order_value"),
        "p95_order_value",
        share("large_cnt", "rows_cnt").alias("large_order_share"),
        "delivered_cnt",
        share("late_cnt", "delivered_cnt").alias("late_delivery_rate"),
        share("bad_cnt", "reviewed_cnt").alias("bad_review_rate"),
        mean("delivery_days").alias("avg_delivery_days"),
    )


def mart_delivery_quality_by_category(items: DataFrame, partials: ItemPartials | None = None) -> DataFrame:
    """Item-weighted on purpose: the question is about products."""
    keys = ["product_category_name_english"]
    p = partials or ItemPartials.of(items)
    parts = [
        merged(p.groups, keys, {"product_category_name_pt": "product_category_name"}),
        p.orders.groupBy(*keys).agg(F.count("order_id").alias("orders_cnt")),
        p.sellers.groupBy(*keys).agg(F.count("seller_id").alias("sellers_cnt")),
        percentiles_of_counts(p.prices, keys, {"p95_price": 0.95}),
    ]
    return merge_groups(parts, keys).select(
        *keys,
        "product_category_name_pt",
        F.col("rows_cnt").alias("items_cnt"),
        "orders_cnt",
        "sellers_cnt",
        F.col("revenue").alias("total_revenue"),
        mean_money("price").alias("avg_price"),
        "p95_price",
        mean("freight_share").alias("avg_freight_share"),
        "delivered_cnt",
        share("late_cnt", "delivered_cnt").alias("late_delivery_rate"),
        mean("delivery_days").alias("avg_delivery_days"),
        share("bad_cnt", "reviewed_cnt").alias("bad_review_rate"),
        mean("review_score").alias("avg_review_score"),
    )


def mart_delivery_quality_by_state(orders: DataFrame, partials: OrderPartials | None = None) -> DataFrame:
    """The days of a state merge into the state."""
    keys = ["customer_state"]
    p = partials or OrderPartials.of(orders)
    people = p.customers.select(*keys, "customer_unique_id").distinct()
    parts = [
        merged(p.days, keys, {"customer_region": "customer_region"}),
        people.groupBy(*keys).agg(F.count("customer_unique_id").alias("unique_customers")),
        percentiles_of_counts(p.delivery, keys, {"p95_delivery_days": 0.95}),
    ]
    return merge_groups(parts, keys).select(
        *keys,
        "customer_region",
        F.col("rows_cnt").alias("orders_cnt"),
        "unique_customers",
        "seller_links_cnt",
        F.col("revenue").alias("total_revenue"),
        mean_money("order_value").alias("avg_order_value"),
        F.col("freight").alias("total_freight"),
        share("freight", "revenue").alias("freight_share_pct"),
        "delivered_cnt",
        share("late_cnt", "delivered_cnt").alias("late_delivery_rate"),
        mean("delivery_days").alias("avg_delivery_days"),
        "p95_delivery_days",
        share("bad_cnt", "reviewed_cnt").alias("bad_review_rate"),
        mean("review_score").alias("avg_review_score"),
        mean("customer_seller_distance_km").alias("avg_distance_km"),
    )


def mart_hourly_order_pattern(orders: DataFrame) -> DataFrame:
    keys = ["order_dow", "order_hour"]
    dow = F.col("order_dow")
    measures = [
        _rows().alias("orders_cnt"),
        F.sum("order_value").alias("total_revenue"),
        avg_money("order_value").alias("avg_order_value"),
        pct(_is("is_large_order"), _rows()).alias("large_order_share"),
        _is("is_delivered").alias("delivered_cnt"),
        _late_rate(),
        _bad_review_rate(),
        pct(_is("is_canceled"), _rows()).alias("cancel_rate"),
    ]
    return group_metrics(
        orders, keys, measures, distinct={"unique_customers": "customer_unique_id"}
    ).select(
        *keys,
        weekday_name(dow).alias("dow_name"),
        flag(dow >= 6).alias("is_weekend"),
        "orders_cnt",
        "unique_customers",
        "total_revenue",
        "avg_order_value",
        "large_order_share",
        "delivered_cnt",
        "late_delivery_rate",
        "bad_review_rate",
        "cancel_rate",
    )


def mart_customer_value_profile(orders: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """Per person, not per order-bound customer_id. Recency counts from the last day of the data."""
    measures = [
        _rows().alias("orders_cnt"),
        F.sum("order_value").alias("total_spend"),
        avg_money("order_value").alias("avg_order_value"),
        F.max("order_value").alias("max_order_value"),
        F.min("order_purchase_date").alias("first_order_date"),
        F.max("order_purchase_date").alias("last_order_date"),
        _is("is_late_delivery").alias("late_orders_cnt"),
        _is("is_bad_review").alias("bad_reviews_cnt"),
        _is("is_canceled").alias("canceled_orders_cnt"),
        _is("has_review").alias("reviewed_orders_cnt"),
        F.avg("review_score").alias("avg_review_score"),
    ]
    labels = {"customer_state": "customer_state", "customer_region": "customer_region"}
    people = group_metrics(orders, ["customer_unique_id"], measures, labels=labels)
    # One row, read from one column of the order table instead of a second aggregation per person.
    last_day = orders.agg(F.max("order_purchase_date").alias("dataset_last_date"))
    segment = (
        F.when(F.col("total_spend") >= settings.customer_high_value_threshold, "HIGH")
        .when(F.col("total_spend") >= settings.customer_medium_value_threshold, "MEDIUM")
        .otherwise("LOW")
    )
    return people.crossJoin(F.broadcast(last_day)).select(
        "customer_unique_id",
        "customer_state",
        "customer_region",
        "orders_cnt",
        "total_spend",
        "avg_order_value",
        "max_order_value",
        "first_order_date",
        "last_order_date",
        day_diff("last_order_date", "dataset_last_date").alias("recency_days"),
        "late_orders_cnt",
        "bad_reviews_cnt",
        "canceled_orders_cnt",
        "reviewed_orders_cnt",
        "avg_review_score",
        flag(F.col("orders_cnt") > 1).alias("is_repeat_customer"),
        segment.alias("value_segment"),
    )


def mart_seller_analytics(items: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """Seller scorecard. Rates are item-weighted.

    Labels and categories are reduced to their distinct combinations per seller first, so the
    category list is built from those few rows.
    """
    keys = ["seller_id"]
    measures = [
        _rows().alias("items_sold"),
        F.sum("item_total").alias("total_revenue"),
        avg_money("price").alias("avg_price"),
        F.sum("freight_value").alias("total_freight"),
        _is("is_delivered").alias("delivered_cnt"),
        _late_rate(),
        F.avg("delivery_days").alias("avg_delivery_days"),
        _is("has_review").alias("reviewed_cnt"),
        _bad_review_rate(),
        F.avg("review_score").alias("avg_review_score"),
        F.avg("customer_seller_distance_km").alias("avg_distance_km"),
    ]
    distinct = {"orders_cnt": "order_id", "unique_products": "product_id", "states_served": "customer_state"}
    category = F.col("product_category_name_english")
    labels = (
        items.select("seller_id", "seller_state", "seller_city", "seller_region", category)
        .distinct()
        .groupBy("seller_id")
        .agg(
            F.min("seller_state").alias("seller_state"),
            F.min("seller_city").alias("seller_city"),
            F.min("seller_region").alias("seller_region"),
            F.size(F.collect_set(category)).alias("unique_categories"),
            string_agg_distinct(category).alias("categories"),
        )
    )
    slow = (F.col("orders_cnt") >= settings.seller_min_orders) & (
        F.col("late_delivery_rate") > settings.seller_late_rate_threshold
    )
    return group_metrics(items, keys, measures, distinct=distinct, more=[labels]).select(
        "seller_id",
        "seller_state",
        "seller_city",
        "seller_region",
        "items_sold",
        "orders_cnt",
        "unique_products",
        "unique_categories",
        "categories",
        "states_served",
        "total_revenue",
        "avg_price",
        "total_freight",
        "delivered_cnt",
        "late_delivery_rate",
        "avg_delivery_days",
        "reviewed_cnt",
        "bad_review_rate",
        "avg_review_score",
        "avg_distance_km",
        flag(slow).alias("is_underperforming"),
    )


def order_product_dims(items: DataFrame, products: DataFrame, heavy: Sequence = ()) -> DataFrame:
    """Main category, weight and volume per order.

    Items are exchanged once, by order; the values of an order's categories and the best of them come from that
    distribution. Orders named in ``heavy`` (see ``functions.skew``) take the way of ``_heavy_dims`` instead.
    """
    goods = products.select(
        "product_id", "product_category_name_english", "product_weight_g", "product_volume_cm3"
    )

    def met(rows: DataFrame) -> DataFrame:
        return rows.select("order_id", "product_id", "price").join(goods, "product_id", "left").select(
            "order_id",
            F.coalesce("product_category_name_english", F.lit(UNKNOWN)).alias("category"),
            "price",
            F.coalesce("product_weight_g", F.lit(0.0)).alias("weight"),
            F.coalesce("product_volume_cm3", F.lit(0.0)).alias("volume"),
        )

    def valued(rows: DataFrame) -> DataFrame:
        return rows.withColumn("value", F.sum("price").over(Window.partitionBy("order_id", "category")))

    ordinary, hot = split_keys(items, "order_id", heavy)
    value = F.col("value")
    # The largest value first, as in sorting: NaN, numbers falling, NULL; then the first category.
    rank = F.struct(value.isNull().alias("none"), (~F.isnan(value)).alias("number"), (-value).alias("rank"), "category")
    measures = {
        "best": F.min(rank),
        "total_weight_g": F.sum("weight"),
        "total_volume_cm3": F.sum("volume"),
        "max_item_weight_g": F.max("weight"),
    }
    names = ["total_weight_g", "total_volume_cm3", "max_item_weight_g"]
    dims = collapse(met(ordinary), "order_id", measures, valued).select(
        "order_id", F.col("best.category").alias("main_product_category"), *names
    )
    return dims.unionByName(_heavy_dims(met(hot))) if heavy else dims


def _heavy_dims(items: DataFrame) -> DataFrame:
    """The same for orders that no task should hold.

    Items collapse to one row per order and category before they move, so the window of the ranking sees at
    most as many rows per order as there are categories.
    """
    by_category = items.groupBy("order_id", "category").agg(
        F.sum("price").alias("category_value"),
        F.sum("weight").alias("weight"),
        F.sum("volume").alias("volume"),
        F.max("weight").alias("max_weight"),
    )
    order = Window.partitionBy("order_id")
    best_first = order.orderBy(F.desc_nulls_last("category_value"), F.asc("category"))
    return (
        by_category.select(
            "order_id",
            F.col("category").alias("main_product_category"),
            F.row_number().over(best_first).alias("category_rank"),
            F.sum("weight").over(order).alias("total_weight_g"),
            F.sum("volume").over(order).alias("total_volume_cm3"),
            F.max("max_weight").over(order).alias("max_item_weight_g"),
        )
        .where(F.col("category_rank") == 1)
        .drop("category_rank")
    )


def mart_order_features(
    orders: DataFrame, items: DataFrame, products: DataFrame, heavy: Sequence = ()
) -> DataFrame:
    """Features of every order, built only from what is known when it is placed."""
    dims = order_product_dims(items, products, heavy).alias("d")
    return orders.alias("o").join(dims, F.col("o.order_id") == F.col("d.order_id"), "left").select(
        "o.order_id",
        "is_late_delivery",
        "items_cnt",
        "distinct_products_cnt",
        "distinct_sellers_cnt",
        "items_value",
        "freight_value",
        "order_value",
        safe_div(F.col("freight_value"), F.col("order_value")).alias("freight_share"),
        "is_large_order",
        F.coalesce("main_payment_type", F.lit(UNKNOWN)).alias("main_payment_type"),
        F.coalesce("max_installments", F.lit(0)).alias("max_installments"),
        "customer_state",
        "customer_region",
        "customer_seller_distance_km",
        "order_hour",
        "order_dow",
        month_of("order_purchase_timestamp").alias("purchase_month"),
        day_diff("order_purchase_timestamp", "order_estimated_delivery_date").alias(
            "estimated_delivery_span_days"
        ),
        F.coalesce("main_product_category", F.lit(UNKNOWN)).alias("main_product_category"),
        F.coalesce("total_weight_g", F.lit(0.0)).alias("total_weight_g"),
        F.coalesce("total_volume_cm3", F.lit(0.0)).alias("total_volume_cm3"),
        F.coalesce("max_item_weight_g", F.lit(0.0)).alias("max_item_weight_g"),
        "order_purchase_timestamp",
    )


def daily_orders(orders: DataFrame, partition_cols: Sequence[str] = (), *, shared_calendar: bool = False) -> DataFrame:
    """Orders per day without gaps, one series per ``partition_cols``: missing days count zero.

    A series runs from its own first to its own last day, or with ``shared_calendar`` over the days of all.
    """
    keys = list(partition_cols)
    counted = (
        orders.where(F.col("order_purchase_date").isNotNull())
        .groupBy(*keys, F.col("order_purchase_date").alias("order_date"))
        .agg(F.count("order_id").alias("orders_cnt"), F.sum("is_canceled").alias("canceled_cnt"))
    )
    return fill_days(counted, "order_date", ["orders_cnt", "canceled_cnt"], keys, shared=shared_calendar)


def mart_daily_order_anomalies(
    orders: DataFrame,
    settings: AnomalySettings,
    partition_cols: Sequence[str] = (),
    *,
    shared_calendar: bool = False,
) -> DataFrame:
    """Days whose order count is far from the days before them, in each series by itself.

    Without ``partition_cols`` there is one series, of all orders.
    """
    keys = list(partition_cols)
    days = daily_orders(orders, keys, shared_calendar=shared_calendar)
    scored = rolling(days, "orders_cnt", "order_date", int(settings.rolling_window_days), keys)
    return scored.withColumns(deviations("z_score", float(settings.anomaly_z_threshold))).select(
        *keys,
        "order_date",
        "orders_cnt",
        "canceled_cnt",
        "rolling_mean",
        "rolling_std",
        "z_score",
        "is_anomaly",
        "anomaly_direction",
    )
