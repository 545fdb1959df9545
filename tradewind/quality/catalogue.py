"""Every declared check, table by table.

Fixed values: the contract of the published project. Per table a line lists, in order, the columns
and what is asked of them: not null, unique, a tuple of accepted values, a range, or a reference to a
parent table. Checks of keys block: a repeated key would multiply rows in every table built on it.
"""

from __future__ import annotations

from dataclasses import dataclass

from tradewind.quality import checks as q

NOT_NULL, UNIQUE = "not null", "unique"
REGIONS = ("Norte", "Nordeste", "Centro-Oeste", "Sudeste", "Sul")
STATUSES = (
    "delivered",
    "shipped",
    "canceled",
    "unavailable",
    "invoiced",
    "processing",
    "created",
    "approved",
)
PAYMENT_TYPES = ("credit_card", "boleto", "voucher", "debit_card", "not_defined")
SEGMENTS = ("LOW", "MEDIUM", "HIGH", "VERY_HIGH", "UNKNOWN")
SCORES = (1, 2, 3, 4, 5)
FLAG = (0, 1)
FRESHNESS = {"column": "order_purchase_timestamp", "warn_after_days": 3650, "error_after_days": 7300}


@dataclass(frozen=True)
class Range:
    low: float | None = None
    high: float | None = None
    severity: str = "error"


@dataclass(frozen=True)
class Parent:
    table: str
    column: str


PERCENT = Range(0, 100)

CONTRACT = {
    "orders": [
        ("order_id", NOT_NULL, UNIQUE),
        ("customer_id", NOT_NULL),
        ("order_status", STATUSES),
        ("order_purchase_timestamp", NOT_NULL),
    ],
    "order_items": [
        ("order_id", NOT_NULL),
        ("order_item_id", NOT_NULL),
        ("product_id", NOT_NULL),
        ("seller_id", NOT_NULL),
        ("price", NOT_NULL),
        (("order_id", "order_item_id"), UNIQUE),
    ],
    "order_payments": [
        ("order_id", NOT_NULL),
        ("payment_type", PAYMENT_TYPES),
        ("payment_value", NOT_NULL),
        (("order_id", "payment_sequential"), UNIQUE),
    ],
    "order_reviews": [
        ("review_id", NOT_NULL),
        ("order_id", NOT_NULL),
        ("review_score", NOT_NULL, SCORES),
    ],
    "customers": [
        ("customer_id", NOT_NULL, UNIQUE),
        ("customer_unique_id", NOT_NULL),
        ("customer_state", NOT_NULL),
    ],
    "sellers": [("seller_id", NOT_NULL, UNIQUE), ("seller_state", NOT_NULL)],
    "products": [("product_id", NOT_NULL, UNIQUE)],
    "geolocation": [
        ("geolocation_zip_code_prefix", NOT_NULL),
        ("geolocation_lat", NOT_NULL),
        ("geolocation_lng", NOT_NULL),
    ],
    "product_category_name_translation": [
        ("product_category_name", NOT_NULL, UNIQUE),
        ("product_category_name_english", NOT_NULL, UNIQUE),
    ],
    "seed_state_region": [
        ("state_code", NOT_NULL, UNIQUE),
        ("state_name", NOT_NULL),
        ("region", NOT_NULL, REGIONS),
    ],
    "stg_orders": [
        ("order_id", NOT_NULL, UNIQUE),
        ("customer_id", NOT_NULL, Parent("stg_customers", "customer_id")),
        ("order_purchase_date", NOT_NULL),
        ("order_hour", Range(0, 23)),
        ("order_dow", Range(1, 7)),
        ("is_delivered", FLAG),
        ("is_canceled", FLAG),
        ("is_late_delivery", FLAG),
    ],
    "stg_order_items": [
        ("order_id", NOT_NULL, Parent("stg_orders", "order_id")),
        ("order_item_id", NOT_NULL),
        ("product_id", NOT_NULL),
        ("seller_id", NOT_NULL),
        ("price", NOT_NULL, Range(0)),
        ("item_total", NOT_NULL),
        ("price_segment", SEGMENTS),
        (("order_id", "order_item_id"), UNIQUE),
    ],
    "stg_order_reviews": [
        ("order_id", NOT_NULL, UNIQUE),
        ("review_id", NOT_NULL),
        ("review_score", NOT_NULL, SCORES),
        ("is_bad_review", FLAG),
        ("is_good_review", FLAG),
    ],
    "stg_order_payments": [
        ("order_id", NOT_NULL, UNIQUE),
        ("payment_total", NOT_NULL),
        ("main_payment_type", PAYMENT_TYPES),
    ],
    "stg_customers": [
        ("customer_id", NOT_NULL, UNIQUE),
        ("customer_unique_id", NOT_NULL),
        ("customer_state", NOT_NULL, Parent("seed_state_region", "state_code")),
    ],
    "stg_sellers": [
        ("seller_id", NOT_NULL, UNIQUE),
        ("seller_state", NOT_NULL, Parent("seed_state_region", "state_code")),
    ],
    "stg_products": [
        ("product_id", NOT_NULL, UNIQUE),
        ("product_category_name", NOT_NULL),
        ("product_category_name_english", NOT_NULL),
    ],
    "stg_geolocation": [
        ("zip_code_prefix", NOT_NULL, UNIQUE),
        ("latitude", NOT_NULL),
        ("longitude", NOT_NULL),
        ("points_cnt", NOT_NULL),
    ],
    "int_orders_enriched": [
        ("order_id", NOT_NULL, UNIQUE),
        ("customer_unique_id", NOT_NULL),
        ("customer_state", NOT_NULL),
        ("customer_region", REGIONS),
        ("order_value", NOT_NULL, Range(0)),
        ("items_cnt", NOT_NULL),
        ("is_large_order", FLAG),
        ("has_review", FLAG),
        ((), "stg_orders"),
    ],
    "int_order_distance": [
        ("order_id", NOT_NULL, UNIQUE),
        ("customer_seller_distance_km", Range(0, 6000)),
    ],
    "int_order_items_enriched": [
        ("order_id", NOT_NULL),
        ("order_item_id", NOT_NULL),
        ("product_category_name_english", NOT_NULL),
        ("seller_id", NOT_NULL),
        ("item_total", NOT_NULL),
        ("price_segment", SEGMENTS),
        (("order_id", "order_item_id"), UNIQUE),
        ((), "stg_order_items"),
    ],
    "mart_daily_state_metrics": [
        ("order_purchase_date", NOT_NULL),
        ("customer_state", NOT_NULL),
        ("orders_cnt", NOT_NULL),
        ("total_revenue", NOT_NULL),
        ("large_order_share", PERCENT),
        ("late_delivery_rate", PERCENT),
        ("bad_review_rate", PERCENT),
        (("order_purchase_date", "customer_state"), UNIQUE),
    ],
    "mart_delivery_quality_by_category": [
        ("product_category_name_english", NOT_NULL, UNIQUE),
        ("items_cnt", NOT_NULL),
        ("orders_cnt", NOT_NULL),
        ("avg_freight_share", Range(0, 1)),
        ("late_delivery_rate", PERCENT),
        ("bad_review_rate", PERCENT),
        ("avg_review_score", Range(1, 5)),
    ],
    "mart_delivery_quality_by_state": [
        ("customer_state", NOT_NULL, UNIQUE),
        ("orders_cnt", NOT_NULL),
        ("unique_customers", NOT_NULL),
        ("late_delivery_rate", PERCENT),
        ("avg_distance_km", Range(0, 6000)),
        ("freight_share_pct", PERCENT),
    ],
    "mart_customer_value_profile": [
        ("customer_unique_id", NOT_NULL, UNIQUE),
        ("orders_cnt", NOT_NULL),
        ("total_spend", NOT_NULL),
        ("recency_days", NOT_NULL, Range(0)),
        ("value_segment", NOT_NULL, ("HIGH", "MEDIUM", "LOW")),
        ("is_repeat_customer", FLAG),
    ],
    "mart_hourly_order_pattern": [
        ("order_dow", NOT_NULL, Range(1, 7)),
        ("order_hour", NOT_NULL, Range(0, 23)),
        ("dow_name", NOT_NULL),
        ("is_weekend", FLAG),
        ("late_delivery_rate", PERCENT),
        ("cancel_rate", PERCENT),
        (("order_dow", "order_hour"), UNIQUE),
    ],
    "mart_seller_analytics": [
        ("seller_id", NOT_NULL, UNIQUE),
        ("items_sold", NOT_NULL),
        ("orders_cnt", NOT_NULL),
        ("total_revenue", NOT_NULL),
        ("unique_categories", NOT_NULL),
        ("states_served", NOT_NULL),
        ("late_delivery_rate", PERCENT),
        ("avg_review_score", Range(1, 5)),
        ("is_underperforming", FLAG),
    ],
    "mart_order_features": [
        ("order_id", NOT_NULL, UNIQUE),
        ("is_late_delivery", FLAG),
        ("items_cnt", NOT_NULL),
        ("order_value", NOT_NULL),
        ("freight_share", Range(0, 1)),
        ("main_payment_type", NOT_NULL),
        ("customer_state", NOT_NULL),
        ("estimated_delivery_span_days", NOT_NULL, Range(0, 180, severity="warn")),
        ("purchase_month", Range(1, 12)),
        ("main_product_category", NOT_NULL),
        ("order_purchase_timestamp", NOT_NULL),
    ],
    "mart_daily_order_anomalies": [
        ("order_date", NOT_NULL, UNIQUE),
        ("orders_cnt", NOT_NULL),
        ("is_anomaly", NOT_NULL, FLAG),
        ("anomaly_direction", ("spike", "drop")),
    ],
}


def _check(table: str, column, asked) -> q.Check:
    if column == ():
        return q.equal_rowcount(table, asked)
    if asked == NOT_NULL:
        return q.not_null(table, column)
    if asked == UNIQUE:
        return (
            q.unique_combination(table, column, blocking=True)
            if isinstance(column, tuple)
            else q.unique(table, column, blocking=True)
        )
    if isinstance(asked, Range):
        return q.accepted_range(table, column, asked.low, asked.high, severity=asked.severity)
    if isinstance(asked, Parent):
        return q.relationship(table, column, asked.table, asked.column)
    return q.accepted_values(table, column, asked)


def declared(table: str | None = None) -> list[q.Check]:
    """The checks of one table, or of all."""
    tables = [table] if table else list(CONTRACT)
    return [
        _check(name, column, asked) for name in tables for column, *rules in CONTRACT[name] for asked in rules
    ]
