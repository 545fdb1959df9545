"""Staging: clean the raw tables and bring each to its grain."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tradewind.config import Settings
from tradewind.functions.expressions import (
    UNKNOWN,
    day_diff,
    dow_of,
    flag,
    hour_of,
    joined_set,
    price_bucket,
    safe_div,
    string_agg_distinct,
    to_date_col,
)
from tradewind.functions.grouping import collapse
from tradewind.functions.skew import split_keys
from tradewind.sources.raw import purchase_window

# Statuses that count as canceled and the coordinate box of Brazil.
CANCELED = ("canceled", "unavailable")
LATITUDE = (-34.0, 6.0)
LONGITUDE = (-74.0, -34.0)


def stg_customers(customers: DataFrame) -> DataFrame:
    """One row per order; the person behind it is customer_unique_id."""
    return customers.select(
        "customer_id",
        "customer_unique_id",
        "customer_zip_code_prefix",
        "customer_city",
        "customer_state",
    )


def stg_geolocation(geolocation: DataFrame) -> DataFrame:
    """Centroid per zip prefix. Outliers go before averaging, or they would drag the centroid.

    Points collapse per prefix, city and state by hashing; the string minima, which need sorting,
    see only those sums.
    """
    inside = F.col("geolocation_lat").between(*LATITUDE) & F.col("geolocation_lng").between(*LONGITUDE)
    places = (
        geolocation.where(inside)
        .groupBy("geolocation_zip_code_prefix", "geolocation_city", "geolocation_state")
        .agg(
            F.sum("geolocation_lat").alias("lat"),
            F.sum("geolocation_lng").alias("lng"),
            F.count(F.lit(1)).alias("points"),
        )
    )
    return places.groupBy(F.col("geolocation_zip_code_prefix").alias("zip_code_prefix")).agg(
        (F.sum("lat") / F.sum("points")).alias("latitude"),
        (F.sum("lng") / F.sum("points")).alias("longitude"),
        F.min("geolocation_city").alias("city"),
        F.min("geolocation_state").alias("state"),
        F.sum("points").alias("points_cnt"),
    )


def item_measures(price: Column, freight: Column) -> list[Column]:
    """What an item's price and freight say by themselves."""
    total = price + freight
    return [
        total.alias("item_total"),
        safe_div(freight, total).alias("freight_share"),
        price_bucket(price).alias("price_segment"),
    ]


def stg_order_items(order_items: DataFrame) -> DataFrame:
    return order_items.select(
        "order_id",
        "order_item_id",
        "product_id",
        "seller_id",
        "shipping_limit_date",
        "price",
        "freight_value",
        *item_measures(F.col("price"), F.col("freight_value")),
    )


def _by_value(value: str, label: str) -> Column:
    rank = F.struct(
        (-F.col(value)).alias("rank"), F.col(label).isNull().alias("missing"), F.col(label).alias("label")
    )
    return F.min(F.when(F.col(value).isNotNull(), rank))


def main_by_value(value: str, label: str) -> Column:
    """Label on the row with the largest value; ties go to the first label, NULL labels come last.

    An ordinary aggregate, so rows of a key are combined before the shuffle; a window maximum would
    first bring them all to one task.
    """
    return _by_value(value, label)["label"]


def _heavy_payments(order_payments: DataFrame) -> DataFrame:
    """Payments of orders that no task should hold: they collapse per order and type before they move."""
    by_type = order_payments.groupBy("order_id", "payment_type").agg(
        F.sum("payment_value").alias("value"),
        F.count(F.lit(1)).alias("payments"),
        F.max("payment_installments").alias("installments"),
        F.max("payment_value").alias("largest"),
    )
    return by_type.groupBy("order_id").agg(
        F.sum("value").alias("payment_total"),
        F.sum("payments").alias("payments_cnt"),
        F.max("installments").alias("max_installments"),
        main_by_value("largest", "payment_type").alias("main_payment_type"),
        string_agg_distinct("payment_type").alias("payment_types"),
    )


def stg_order_payments(order_payments: DataFrame, heavy: Sequence = ()) -> DataFrame:
    """Payments of an order in one row.

    Payment rows are exchanged once, by order, which is also the distribution that the order table joins
    them in. Orders named in ``heavy`` (see ``functions.skew``) take the way of ``_heavy_payments`` instead.
    """
    ordinary, hot = split_keys(order_payments, "order_id", heavy)
    measures = {
        "payment_total": F.sum("payment_value"),
        "payments_cnt": F.count(F.lit(1)),
        "max_installments": F.max("payment_installments"),
        "main": _by_value("payment_value", "payment_type"),
        "types": F.collect_set("payment_type"),
    }
    rows = ordinary.select("order_id", "payment_type", "payment_installments", "payment_value")
    payments = collapse(rows, "order_id", measures).select(
        "order_id",
        "payment_total",
        "payments_cnt",
        "max_installments",
        F.col("main.label").alias("main_payment_type"),
        joined_set("types").alias("payment_types"),
    )
    return payments.unionByName(_heavy_payments(hot)) if heavy else payments


def stg_order_reviews(order_reviews: DataFrame) -> DataFrame:
    """Latest review of each order; equal answer times are settled by review id.

    The rank filter is applied per map task before the shuffle, so an order with very many reviews
    sends one row per task.
    """
    latest_first = Window.partitionBy("order_id").orderBy(
        F.desc_nulls_last("review_answer_timestamp"), F.asc_nulls_last("review_id")
    )
    score, message = F.col("review_score"), F.col("review_comment_message")
    return (
        order_reviews.withColumn("row_number", F.row_number().over(latest_first))
        .where(F.col("row_number") == 1)
        .select(
            "review_id",
            "order_id",
            "review_score",
            "review_comment_title",
            "review_comment_message",
            "review_creation_date",
            "review_answer_timestamp",
            flag(score <= 2).alias("is_bad_review"),
            flag(score >= 4).alias("is_good_review"),
            flag(message.isNotNull() & (message != "")).alias("has_comment"),
        )
    )


def stg_orders(orders: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """Date parts and outcome flags. Lateness is NULL until delivery: unknown is not on time."""
    purchased = F.col("order_purchase_timestamp")
    delivered = F.col("order_delivered_customer_date")
    delay = day_diff("order_estimated_delivery_date", delivered)
    late = flag(delay > settings.late_delivery_grace_days)
    return purchase_window(orders, settings).select(
        "order_id",
        "customer_id",
        "order_status",
        "order_purchase_timestamp",
        to_date_col(purchased).alias("order_purchase_date"),
        hour_of(purchased).alias("order_hour"),
        dow_of(purchased).alias("order_dow"),
        "order_approved_at",
        "order_delivered_carrier_date",
        "order_delivered_customer_date",
        "order_estimated_delivery_date",
        flag(delivered.isNotNull()).alias("is_delivered"),
        flag(F.col("order_status").isin(*CANCELED)).alias("is_canceled"),
        F.when(delivered.isNotNull(), late).alias("is_late_delivery"),
        day_diff(purchased, delivered).alias("delivery_days"),
        delay.alias("delivery_delay_days"),
    )


def stg_products(products: DataFrame, translation: DataFrame) -> DataFrame:
    """Products with their English category; products without one stay, as 'unknown'."""
    english = translation.select(
        F.col("product_category_name").alias("name_key"),
        F.nullif("product_category_name_english", F.lit("")).alias("english"),
    )
    return products.join(english, F.col("product_category_name") == F.col("name_key"), "left").select(
        "product_id",
        F.coalesce("product_category_name", F.lit(UNKNOWN)).alias("product_category_name"),
        F.coalesce("english", F.lit(UNKNOWN)).alias("product_category_name_english"),
        "product_weight_g",
        "product_length_cm",
        "product_height_cm",
        "product_width_cm",
        "product_photos_qty",
        (F.col("product_length_cm") * F.col("product_height_cm") * F.col("product_width_cm")).alias(
            "product_volume_cm3"
        ),
    )


def stg_sellers(sellers: DataFrame) -> DataFrame:
    return sellers.select("seller_id", "seller_zip_code_prefix", "seller_city", "seller_state")
