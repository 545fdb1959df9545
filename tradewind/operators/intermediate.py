"""Intermediate tables: the wide order row, the wide item row, and the buyer-seller distance."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradewind.config import Settings
from tradewind.functions.expressions import flag, haversine_km, price_bucket
from tradewind.functions.grouping import collapse, group_metrics
from tradewind.functions.skew import split_keys
from tradewind.operators.staging import item_measures


ITEM = ("order_id", "product_id", "seller_id", "price", "freight_value")  # item_total is worked out where it is summed
TOTALS = (
    "items_cnt",
    "distinct_products_cnt",
    "distinct_sellers_cnt",
    "items_value",
    "freight_value",
    "order_value",
)


def _sums() -> list[Column]:
    return [
        F.count(F.lit(1)).alias("items_cnt"),
        F.sum("price").alias("items_value"),
        F.sum("freight_value").alias("freight_value"),
        F.sum("item_total").alias("order_value"),
    ]


def _order_measures() -> dict[str, Column]:
    """Sums and sets, as ordinary orders have few items; two distinct counts would exchange every row once more."""
    return {
        "items_cnt": F.count(F.lit(1)),
        "products": F.collect_set("product_id"),
        "sellers": F.collect_set("seller_id"),
        "items_value": F.sum("price"),
        "freight_value": F.sum("freight_value"),
        "order_value": F.sum(F.col("price") + F.col("freight_value")),
    }


def _counted(orders: DataFrame, *more: str) -> DataFrame:
    sizes = [
        F.size(which).cast("bigint").alias(name)
        for name, which in (("distinct_products_cnt", "products"), ("distinct_sellers_cnt", "sellers"))
    ]
    return orders.select("order_id", "items_cnt", *sizes, "items_value", "freight_value", "order_value", *more)


def _heavy_totals(items: DataFrame) -> DataFrame:
    """Totals of orders that no task should hold: sums collapse map-side, distinct counts travel as pairs."""
    distinct = {"distinct_products_cnt": "product_id", "distinct_sellers_cnt": "seller_id"}
    return group_metrics(items, ["order_id"], _sums(), distinct=distinct)


def order_totals(items: DataFrame, heavy: Sequence = ()) -> DataFrame:
    """Items of an order in one row, before any join can multiply them.

    Item rows are exchanged once, by order; sums and both distinct counts reuse that distribution. Orders
    named in ``heavy`` (see ``functions.skew``) take the way of ``_heavy_totals`` instead.
    """
    ordinary, hot = split_keys(items, "order_id", heavy)
    totals = _counted(collapse(ordinary.select(*ITEM), "order_id", _order_measures()))
    if heavy:
        totals = totals.unionByName(_heavy_totals(hot))
    return totals.select("order_id", *TOTALS)


def _located(df: DataFrame, zip_column: str, geo: DataFrame, role: str) -> DataFrame:
    """Radians of a zip prefix's centroid; NULL where the prefix has none."""
    points = geo.select(
        F.col("zip_code_prefix").alias(f"{role}_zip"),
        F.radians("latitude").alias(f"{role}_lat"),
        F.radians("longitude").alias(f"{role}_lon"),
    )
    return df.join(points, F.col(zip_column) == F.col(f"{role}_zip"), "left")


def _buyer_points(orders: DataFrame, customers: DataFrame, geo: DataFrame) -> DataFrame:
    """Per order: where its customer lives, as radians that are NULL where the prefix is unknown."""
    buyers = orders.select("order_id", "customer_id").join(
        customers.select("customer_id", "customer_zip_code_prefix"), "customer_id"
    )
    points = _located(buyers, "customer_zip_code_prefix", geo, "customer")
    return points.groupBy(F.col("order_id").alias("buyer_order")).agg(
        F.min("customer_lat").alias("customer_lat"), F.min("customer_lon").alias("customer_lon")
    )


def seller_points(sellers: DataFrame, geo: DataFrame) -> DataFrame:
    """Per seller, once: where it is, as radians that are NULL where the prefix is unknown."""
    points = _located(sellers.select("seller_id", "seller_zip_code_prefix"), "seller_zip_code_prefix", geo, "seller")
    return points.groupBy(F.col("seller_id").alias("known_seller")).agg(
        F.min("seller_lat").alias("seller_lat"), F.min("seller_lon").alias("seller_lon")
    )


def order_item_facts(
    items: DataFrame,
    orders: DataFrame,
    customers: DataFrame,
    sellers: DataFrame,
    geo: DataFrame,
    heavy: Sequence = (),
    points: DataFrame | None = None,
) -> DataFrame:
    """All that items say about their order, one row per order that has any: totals, and the kilometres from
    the buyer to the nearest seller.

    Item rows meet the sellers' points where they are, and are exchanged once, by order. They meet the buyer's
    point in that distribution, so a distance is one expression per row instead of a set of points, and collapse
    there to one row per order. ``points`` are the ``seller_points`` as a written dimension, whose file size the
    planner knows. ``has_distance`` tells whether the order, its customer and one of its sellers are known. Of the
    ``heavy`` orders only the distinct sellers meet the buyers, whose points are at most a thousand rows.
    """
    ordinary, hot = split_keys(items.where(F.col("order_id").isNotNull()), "order_id", heavy)
    where_sellers_are = seller_points(sellers, geo) if points is None else points
    buyers = _buyer_points(orders, customers, geo)
    buyer = F.col("customer_lat"), F.col("customer_lon")
    distance = haversine_km(*buyer, F.col("seller_lat"), F.col("seller_lon"))
    nearest = {
        "has_distance": F.max(F.col("known_seller").isNotNull() & F.col("buyer_order").isNotNull()),
        "customer_seller_distance_km": F.min(distance),
    }

    def placed(rows: DataFrame) -> DataFrame:
        return rows.join(where_sellers_are, F.col("seller_id") == F.col("known_seller"), "left")

    def with_buyer(rows: DataFrame) -> DataFrame:
        return rows.join(buyers, F.col("order_id") == F.col("buyer_order"), "left")

    met = placed(ordinary.select(*ITEM)).select(*ITEM, "known_seller", "seller_lat", "seller_lon")
    facts = _counted(collapse(met, "order_id", {**_order_measures(), **nearest}, with_buyer), *nearest)
    if heavy:
        own = buyers.where(F.col("buyer_order").isin(list(heavy)))
        pairs = placed(hot.select("order_id", "seller_id").distinct())
        near = pairs.join(F.broadcast(own), F.col("order_id") == F.col("buyer_order"), "left")
        near = near.groupBy(F.col("order_id").alias("near_order")).agg(*[m.alias(n) for n, m in nearest.items()])
        totals = _heavy_totals(hot).join(near, F.col("order_id") == F.col("near_order"))
        facts = facts.unionByName(totals.drop("near_order"))
    return facts.select("order_id", *TOTALS, "has_distance", "customer_seller_distance_km")


def int_order_distance(facts: DataFrame) -> DataFrame:
    """Kilometres from the buyer to the nearest seller of the order."""
    return facts.where("has_distance").select("order_id", "customer_seller_distance_km")


def int_orders_enriched(
    orders: DataFrame,
    customers: DataFrame,
    facts: DataFrame,
    payments: DataFrame,
    reviews: DataFrame,
    regions: DataFrame,
    settings: Settings = Settings(),
) -> DataFrame:
    """One row per order. Customers join inner; everything else left, and unique on its key."""
    totals = facts.alias("t")
    order_value = F.coalesce("t.order_value", F.lit(0.0))

    def count_or_zero(name: str):
        return F.coalesce(f"t.{name}", F.lit(0)).alias(name)

    def amount_or_zero(name: str):
        return F.coalesce(f"t.{name}", F.lit(0.0)).alias(name)

    joined = (
        orders.alias("o")
        .join(customers.alias("c"), F.col("o.customer_id") == F.col("c.customer_id"))
        .join(regions.alias("r"), F.col("c.customer_state") == F.col("r.state_code"), "left")
        .join(totals, F.col("o.order_id") == F.col("t.order_id"), "left")
        .join(payments.alias("p"), F.col("o.order_id") == F.col("p.order_id"), "left")
        .join(reviews.alias("rv"), F.col("o.order_id") == F.col("rv.order_id"), "left")
    )
    return joined.select(
        "o.order_id",
        "o.order_status",
        "o.order_purchase_timestamp",
        "o.order_purchase_date",
        "o.order_hour",
        "o.order_dow",
        "o.order_delivered_customer_date",
        "o.order_estimated_delivery_date",
        "o.is_delivered",
        "o.is_canceled",
        "o.is_late_delivery",
        "o.delivery_days",
        "o.delivery_delay_days",
        "c.customer_id",
        "c.customer_unique_id",
        "c.customer_state",
        "c.customer_city",
        F.col("r.region").alias("customer_region"),
        count_or_zero("items_cnt"),
        count_or_zero("distinct_products_cnt"),
        count_or_zero("distinct_sellers_cnt"),
        amount_or_zero("items_value"),
        amount_or_zero("freight_value"),
        amount_or_zero("order_value"),
        price_bucket(order_value).alias("order_value_segment"),
        flag(order_value >= settings.large_order_threshold).alias("is_large_order"),
        "p.payment_total",
        "p.main_payment_type",
        "p.max_installments",
        "rv.review_score",
        "rv.is_bad_review",
        "rv.is_good_review",
        flag(F.col("rv.order_id").isNotNull()).alias("has_review"),
        "t.customer_seller_distance_km",
    )


def int_order_items_enriched(
    items: DataFrame, orders_enriched: DataFrame, products: DataFrame, sellers: DataFrame, regions: DataFrame
) -> DataFrame:
    """One row per item. Product and seller keys come from the dimension: NULL when unmatched.

    What follows from price and freight is worked out after the joins instead of travelling through them. Products
    come first, so that if they are too many to be broadcast, items meet them before the columns of their orders.
    """
    return (
        items.alias("i")
        .join(products.alias("p"), F.col("i.product_id") == F.col("p.product_id"), "left")
        .join(orders_enriched.alias("o"), F.col("i.order_id") == F.col("o.order_id"))
        .join(sellers.alias("s"), F.col("i.seller_id") == F.col("s.seller_id"), "left")
        .join(regions.alias("r"), F.col("s.seller_state") == F.col("r.state_code"), "left")
        .select(
            "i.order_id",
            "i.order_item_id",
            "i.price",
            "i.freight_value",
            *item_measures(F.col("i.price"), F.col("i.freight_value")),
            "p.product_id",
            "p.product_category_name",
            "p.product_category_name_english",
            "p.product_weight_g",
            "p.product_volume_cm3",
            "s.seller_id",
            "s.seller_state",
            "s.seller_city",
            F.col("r.region").alias("seller_region"),
            "o.order_purchase_date",
            "o.order_hour",
            "o.order_dow",
            "o.customer_state",
            "o.customer_region",
            "o.order_status",
            "o.is_delivered",
            "o.is_canceled",
            "o.is_late_delivery",
            "o.delivery_days",
            "o.review_score",
            "o.is_bad_review",
            "o.has_review",
            "o.customer_seller_distance_km",
        )
    )
