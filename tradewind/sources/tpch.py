"""The raw marketplace tables as views over TPC-H-like parquet tables.

Every derivation is integer arithmetic on keys, so another engine gets the same rows. All tables
but ``customers``, ``sellers``, ``geolocation`` and ``seed_state_region`` are plain projections;
those four join the small nation and region tables.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tradewind.config import Settings

# Fixed values of the mapping.
STATUS = {"F": "delivered", "O": "shipped"}
PAYMENT_TYPES = {"A": "credit_card", "N": "boleto", "R": "voucher"}
REVIEW_SCORES = {"purchase": 5, "signup": 4, "view": 3, "click": 2, "error": 1}
UNTRANSLATED = "PROMO"


def _days(n: Column) -> Column:
    return F.make_dt_interval(days=n.cast("int"))


def _hours(n: Column) -> Column:
    return F.make_dt_interval(hours=n.cast("int"))


def _lookup(column: Column, values: dict) -> Column:
    result = None
    for key, value in values.items():
        result = (F if result is None else result).when(column == key, value)
    return result


def _line_id() -> Column:
    """Number of a line within its order: 60 bits of a hash over the line's fields.

    The line numbers of the data repeat. Numbering the lines again would sort every order in one
    task; the hash needs no shuffle.
    """
    fields = F.concat_ws(
        "|",
        F.col("l_linenumber"),
        F.col("l_partkey"),
        F.col("l_suppkey"),
        _cents("l_extendedprice"),
        F.to_date("l_shipdate"),
    )
    number = F.conv(F.substring(F.md5(fields), 1, 15), 16, 10).cast("bigint")
    return F.coalesce(number, F.lit(0))  # never NULL, which the planner does not know of conv


def _cents(name: str) -> Column:
    return F.round(F.col(name) * 100).cast("bigint")


def _city(key: str) -> Column:
    return F.concat(F.lit("CITY_"), F.col(key) % 10)


def orders(t: dict[str, DataFrame]) -> DataFrame:
    key = F.col("o_orderkey")
    placed = F.col("o_orderdate") + _hours(key % 24)
    open_order = F.col("o_orderstatus") == "P"
    return t["orders"].select(
        key.alias("order_id"),
        key.alias("customer_id"),
        F.coalesce(
            _lookup(F.col("o_orderstatus"), STATUS),
            F.when(key % 5 == 0, "canceled").otherwise("processing"),
        ).alias("order_status"),
        placed.alias("order_purchase_timestamp"),
        (placed + _hours(key % 12)).alias("order_approved_at"),
        F.when(~open_order, F.col("o_orderdate") + _days(1 + key % 3)).alias("order_delivered_carrier_date"),
        F.when(~open_order, placed + _days(3 + (key * 7) % 25)).alias("order_delivered_customer_date"),
        (F.col("o_orderdate") + _days(10 + key % 21)).alias("order_estimated_delivery_date"),
    )


def customers(t: dict[str, DataFrame]) -> DataFrame:
    return (
        t["orders"]
        .join(t["customer"], F.col("o_custkey") == F.col("c_custkey"))
        .join(t["nation"], F.col("c_nationkey") == F.col("n_nationkey"))
        .select(
            F.col("o_orderkey").alias("customer_id"),
            F.col("o_custkey").alias("customer_unique_id"),
            (F.col("c_nationkey") * 10 + F.col("c_custkey") % 10).alias("customer_zip_code_prefix"),
            _city("c_custkey").alias("customer_city"),
            F.col("n_name").alias("customer_state"),
        )
    )


def order_items(t: dict[str, DataFrame]) -> DataFrame:
    cents = _cents("l_extendedprice")
    price = F.expr(
        "(cast(round(l_extendedprice * 100) as bigint)"
        " * (100 - cast(round(l_discount * 100) as bigint))) div 20000"
    )
    freight = F.expr(
        "(cast(round(l_extendedprice * 100) as bigint) * cast(round(l_tax * 100) as bigint)) div 20000"
    )
    return t["lineitem"].select(
        F.col("l_orderkey").alias("order_id"),
        _line_id().alias("order_item_id"),
        F.col("l_partkey").alias("product_id"),
        F.col("l_suppkey").alias("seller_id"),
        F.col("l_shipdate").alias("shipping_limit_date"),
        (price / F.lit(100.0)).alias("price"),
        (freight / F.lit(100.0)).alias("freight_value"),
    )


def order_payments(t: dict[str, DataFrame]) -> DataFrame:
    return t["lineitem"].select(
        F.col("l_orderkey").alias("order_id"),
        _line_id().alias("payment_sequential"),
        _lookup(F.col("l_returnflag"), PAYMENT_TYPES).alias("payment_type"),
        F.col("l_linenumber").alias("payment_installments"),
        F.col("l_extendedprice").alias("payment_value"),
    )


def order_reviews(t: dict[str, DataFrame]) -> DataFrame:
    event = F.col("event_id")
    order_count = t["orders"].agg(F.count(F.lit(1)).alias("order_count"))
    return t["events"].crossJoin(F.broadcast(order_count)).select(
        event.alias("review_id"),
        ((F.col("user_id") * 97 + event) % F.col("order_count")).alias("order_id"),
        _lookup(F.col("event_type"), REVIEW_SCORES).alias("review_score"),
        F.when(event % 3 == 0, F.col("event_type")).alias("review_comment_title"),
        F.when(event % 4 == 0, "").when(event % 4 != 1, F.col("props")).alias("review_comment_message"),
        (F.col("ts") - _hours(event % 48)).alias("review_creation_date"),
        F.col("ts").alias("review_answer_timestamp"),
    )


def sellers(t: dict[str, DataFrame]) -> DataFrame:
    return t["supplier"].join(t["nation"], F.col("s_nationkey") == F.col("n_nationkey")).select(
        F.col("s_suppkey").alias("seller_id"),
        (F.col("s_nationkey") * 10 + F.col("s_suppkey") % 10).alias("seller_zip_code_prefix"),
        _city("s_suppkey").alias("seller_city"),
        F.col("n_name").alias("seller_state"),
    )


def products(t: dict[str, DataFrame]) -> DataFrame:
    key, size = F.col("p_partkey"), F.col("p_size").cast("double")
    return t["part"].select(
        key.alias("product_id"),
        F.when(key % 50 != 0, F.col("p_type")).alias("product_category_name"),
        F.when(key % 41 != 0, size * 100).alias("product_weight_g"),
        size.alias("product_length_cm"),
        (size % 10 + 1).alias("product_height_cm"),
        (size % 7 + 2).alias("product_width_cm"),
        (size % 5).alias("product_photos_qty"),
    )


def geolocation(t: dict[str, DataFrame]) -> DataFrame:
    key = F.col("c_custkey")
    return t["customer"].join(t["nation"], F.col("c_nationkey") == F.col("n_nationkey")).select(
        (F.col("c_nationkey") * 10 + key % 10).alias("geolocation_zip_code_prefix"),
        (key % 50 - 40).cast("double").alias("geolocation_lat"),
        (key % 53 - 80).cast("double").alias("geolocation_lng"),
        _city("c_custkey").alias("geolocation_city"),
        F.col("n_name").alias("geolocation_state"),
    )


def translation(t: dict[str, DataFrame]) -> DataFrame:
    """English names of the kinds of parts, all but one of them."""
    kinds = t["part"].where(F.col("p_type") != UNTRANSLATED).select(F.col("p_type").alias("product_category_name"))
    return kinds.distinct().withColumn(
        "product_category_name_english", F.concat(F.lower("product_category_name"), F.lit("_goods"))
    )


def state_region(t: dict[str, DataFrame]) -> DataFrame:
    return t["nation"].join(t["region"], F.col("n_regionkey") == F.col("r_regionkey")).select(
        F.col("n_name").alias("state_code"),
        F.col("n_name").alias("state_name"),
        F.col("r_name").alias("region"),
    )


def _near_window(orders: DataFrame, settings: Settings) -> DataFrame:
    """Orders that may be purchased in the window: within a day, as the time of day is added to the date.

    The bound on the plain column reaches the file scan, which the exact one on the sum does not.
    """
    if not (settings.start_date and settings.end_date):
        return orders
    start, end = (F.lit(x).cast("timestamp_ntz") for x in (settings.start_date, settings.end_date))
    day = F.make_dt_interval(days=F.lit(1))
    return orders.where((F.col("o_orderdate") >= start - day) & (F.col("o_orderdate") < end))


def raw_tables(spark: SparkSession, folder: str, settings: Settings = Settings()) -> dict[str, DataFrame]:
    names = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events")
    t = {name: spark.read.parquet(f"{folder}/{name}.parquet") for name in names}
    return {
        "orders": orders({**t, "orders": _near_window(t["orders"], settings)}),
        "order_items": order_items(t),
        "order_payments": order_payments(t),
        "order_reviews": order_reviews(t),
        "customers": customers(t),
        "sellers": sellers(t),
        "products": products(t),
        "geolocation": geolocation(t),
        "product_category_name_translation": translation(t),
        "seed_state_region": state_region(t),
    }
