"""Column types of every registered query, in output order.

Written as DDL; besides Spark's types there are three kinds of double precision numbers: money (2 digits),
km (6 digits) and real, any other (9 digits).

Two engines add floats in different orders, so reals are compared at a fixed number of decimals, in
double precision. Sums of cents are exact at two digits; averages of cents are whole sums divided
once, so both engines get the same double.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

DIGITS = {"money": 2, "km": 6, "real": 9}
SQL_TYPES = {"bigint": "BIGINT", "string": "VARCHAR", "date": "DATE", "timestamp_ntz": "TIMESTAMP", "boolean": "BOOLEAN"}

ORDER_FLAGS = "is_delivered bigint, is_canceled bigint, is_late_delivery bigint, delivery_days bigint"
CHECK_RESULT = "table_name string, check_name string, severity string, blocking boolean, violations bigint, passed boolean"

CONTRACTS = {
    "stg_customers": "customer_id bigint, customer_unique_id bigint, customer_zip_code_prefix bigint, customer_city string"
    ", customer_state string",
    "stg_geolocation": "zip_code_prefix bigint, latitude real, longitude real, city string, state string, points_cnt bigint",
    "stg_order_items": "order_id bigint, order_item_id bigint, product_id bigint, seller_id bigint, shipping_limit_date timestamp_ntz, price money"
    ", freight_value money, item_total money, freight_share real, price_segment string",
    "stg_order_payments": "order_id bigint, payment_total money, payments_cnt bigint, max_installments bigint, main_payment_type string"
    ", payment_types string",
    "stg_order_reviews": "review_id bigint, order_id bigint, review_score bigint, review_comment_title string"
    ", review_comment_message string, review_creation_date timestamp_ntz, review_answer_timestamp timestamp_ntz, is_bad_review bigint"
    ", is_good_review bigint, has_comment bigint",
    "stg_orders": "order_id bigint, customer_id bigint, order_status string, order_purchase_timestamp timestamp_ntz, order_purchase_date date"
    ", order_hour bigint, order_dow bigint, order_approved_at timestamp_ntz, order_delivered_carrier_date timestamp_ntz"
    f", order_delivered_customer_date timestamp_ntz, order_estimated_delivery_date timestamp_ntz, {ORDER_FLAGS}, delivery_delay_days bigint",
    "stg_products": "product_id bigint, product_category_name string, product_category_name_english string"
    ", product_weight_g real, product_length_cm real, product_height_cm real, product_width_cm real, product_photos_qty real"
    ", product_volume_cm3 real",
    "stg_sellers": "seller_id bigint, seller_zip_code_prefix bigint, seller_city string, seller_state string",
    "int_order_distance": "order_id bigint, customer_seller_distance_km km",
    "int_orders_enriched": "order_id bigint, order_status string, order_purchase_timestamp timestamp_ntz, order_purchase_date date"
    ", order_hour bigint, order_dow bigint, order_delivered_customer_date timestamp_ntz, order_estimated_delivery_date timestamp_ntz"
    f", {ORDER_FLAGS}, delivery_delay_days bigint, customer_id bigint, customer_unique_id bigint, customer_state string"
    ", customer_city string, customer_region string, items_cnt bigint, distinct_products_cnt bigint, distinct_sellers_cnt bigint"
    ", items_value money, freight_value money, order_value money, order_value_segment string, is_large_order bigint, payment_total money"
    ", main_payment_type string, max_installments bigint, review_score bigint, is_bad_review bigint, is_good_review bigint, has_review bigint"
    ", customer_seller_distance_km km",
    "int_order_items_enriched": "order_id bigint, order_item_id bigint, price money, freight_value money, item_total money"
    ", freight_share real, price_segment string, product_id bigint, product_category_name string, product_category_name_english string"
    ", product_weight_g real, product_volume_cm3 real, seller_id bigint, seller_state string, seller_city string, seller_region string"
    ", order_purchase_date date, order_hour bigint, order_dow bigint, customer_state string, customer_region string, order_status string"
    f", {ORDER_FLAGS}, review_score bigint, is_bad_review bigint, has_review bigint, customer_seller_distance_km km",
    "mart_daily_state_metrics": "order_purchase_date date, customer_state string, customer_region string, orders_cnt bigint"
    ", unique_customers bigint, total_revenue money, avg_order_value real, p95_order_value real, large_order_share money"
    ", delivered_cnt bigint, late_delivery_rate money, bad_review_rate money, avg_delivery_days real",
    "mart_delivery_quality_by_category": "product_category_name_english string, product_category_name_pt string"
    ", items_cnt bigint, orders_cnt bigint, sellers_cnt bigint, total_revenue money, avg_price real, p95_price real, avg_freight_share real"
    ", delivered_cnt bigint, late_delivery_rate money, avg_delivery_days real, bad_review_rate money, avg_review_score real",
    "mart_delivery_quality_by_state": "customer_state string, customer_region string, orders_cnt bigint, unique_customers bigint"
    ", seller_links_cnt bigint, total_revenue money, avg_order_value real, total_freight money, freight_share_pct money"
    ", delivered_cnt bigint, late_delivery_rate money, avg_delivery_days real, p95_delivery_days real, bad_review_rate money"
    ", avg_review_score real, avg_distance_km km",
    "mart_hourly_order_pattern": "order_dow bigint, order_hour bigint, dow_name string, is_weekend bigint, orders_cnt bigint"
    ", unique_customers bigint, total_revenue money, avg_order_value real, large_order_share money, delivered_cnt bigint"
    ", late_delivery_rate money, bad_review_rate money, cancel_rate money",
    "mart_customer_value_profile": "customer_unique_id bigint, customer_state string, customer_region string, orders_cnt bigint"
    ", total_spend money, avg_order_value real, max_order_value money, first_order_date date, last_order_date date, recency_days bigint"
    ", late_orders_cnt bigint, bad_reviews_cnt bigint, canceled_orders_cnt bigint, reviewed_orders_cnt bigint, avg_review_score real"
    ", is_repeat_customer bigint, value_segment string",
    "mart_seller_analytics": "seller_id bigint, seller_state string, seller_city string, seller_region string, items_sold bigint"
    ", orders_cnt bigint, unique_products bigint, unique_categories bigint, categories string, states_served bigint, total_revenue money"
    ", avg_price real, total_freight money, delivered_cnt bigint, late_delivery_rate money, avg_delivery_days real, reviewed_cnt bigint"
    ", bad_review_rate money, avg_review_score real, avg_distance_km km, is_underperforming bigint",
    "mart_order_features": "order_id bigint, is_late_delivery bigint, items_cnt bigint, distinct_products_cnt bigint"
    ", distinct_sellers_cnt bigint, items_value money, freight_value money, order_value money, freight_share real, is_large_order bigint"
    ", main_payment_type string, max_installments bigint, customer_state string, customer_region string"
    ", customer_seller_distance_km km, order_hour bigint, order_dow bigint, purchase_month bigint"
    ", estimated_delivery_span_days bigint, main_product_category string, total_weight_g real, total_volume_cm3 real"
    ", max_item_weight_g real, order_purchase_timestamp timestamp_ntz",
    "mart_daily_order_anomalies": "order_date date, orders_cnt bigint, canceled_cnt bigint, rolling_mean real, rolling_std real"
    ", z_score real, is_anomaly bigint, anomaly_direction string",
    # Sources and sinks
    "raw_state_region": "state_code string, state_name string, region string",
    "raw_products_reloaded": "product_id bigint, product_category_name string, product_weight_g real, product_length_cm real"
    ", product_height_cm real, product_width_cm real, product_photos_qty real",
    "raw_order_payments": "order_id bigint, payment_sequential bigint, payment_type string, payment_installments bigint"
    ", payment_value money",
    "stg_orders_window": "order_id bigint, order_purchase_timestamp timestamp_ntz, is_late_delivery bigint",
    "stg_orders_month_window": "order_id bigint, order_purchase_timestamp timestamp_ntz, is_late_delivery bigint",
    "sink_backfilled_months": "purchase_ym string, rows_cnt bigint, delivered_cnt bigint",
    "sink_published_sellers": "seller_state string, sellers_cnt bigint",
    "raw_accounting": "accepted bigint, rejected bigint, accepted_length real, rejected_length real",
    "sink_monthly_partitions": "purchase_ym string, rows_cnt bigint, orders_cnt bigint, total_revenue money",
    "sink_train_holdout": "part string, rows_cnt bigint, late_cnt bigint",
    # Single operators
    "order_totals": "order_id bigint, items_cnt bigint, distinct_products_cnt bigint, distinct_sellers_cnt bigint, items_value money"
    ", freight_value money, order_value money",
    "order_product_dims": "order_id bigint, main_product_category string, total_weight_g real, total_volume_cm3 real"
    ", max_item_weight_g real",
    "daily_orders": "order_date date, orders_cnt bigint, canceled_cnt bigint",
    "seller_price_percentiles": "seller_id bigint, p05_price real, median_price real, p95_price real",
    "state_categories": "customer_state string, categories string",
    "class_balance": "positive_rate real, known_cnt bigint, unknown_cnt bigint",
    "price_segments": "price_segment string, items_cnt bigint, freight_share real",
    "order_calendar": "order_dow bigint, dow_name string, purchase_month bigint, order_hour bigint, orders_cnt bigint, avg_delay_days real",
    "seller_state_distance": "seller_state string, customer_state string, nearest_km km, mean_km km",
    "anomalies_short_window": "order_date date, orders_cnt bigint, z_score real, is_anomaly bigint, anomaly_direction string",
    "anomalies_by_state": "customer_state string, order_date date, orders_cnt bigint, canceled_cnt bigint, rolling_mean real"
    ", rolling_std real, z_score real, is_anomaly bigint, anomaly_direction string",
    "anomalies_by_status_shared_calendar": "customer_region string, order_status string, order_date date, orders_cnt bigint"
    ", canceled_cnt bigint, rolling_mean real, rolling_std real, z_score real, is_anomaly bigint, anomaly_direction string",
    "daily_orders_by_region": "customer_region string, order_date date, orders_cnt bigint, canceled_cnt bigint",
    # Checks across tables
    "dq_reconciliation": "check_name string, violations bigint, passed boolean",
    "dq_revenue_totals": "mart_revenue money, source_revenue money, difference money",
    "dq_rates": "model_name string, metric_name string, rates_cnt bigint, undefined_cnt bigint, out_of_bounds_cnt bigint, max_rate money",
    "dq_negative_amounts": "source_column string, bad_cnt bigint",
    "dq_freshness": "newest timestamp_ntz, age_days bigint, status string",
    "dq_stored_failures": "customer_region string, failing_cnt bigint",
    "dq_failed_checks": "table_name string, check_name string, failing_cnt bigint",
    "dq_duplicate_lines": "order_id bigint, line_number bigint, n_records bigint",
    # Training
    "ml_features": "order_id bigint, items_cnt real, order_value money, freight_share real, max_installments real"
    ", customer_seller_distance_km km, estimated_delivery_span_days real, purchase_month real, total_weight_g real"
    ", customer_state string, main_payment_type string, is_late_delivery bigint",
    "ml_split": "order_id bigint, bucket bigint, part string",
    "ml_training_metadata": "rows_train bigint, rows_holdout bigint, positive_rate real, features string",
    "ml_medians": "feature string, median km",
    "ml_scaling": "feature string, mean km, std km",
    "ml_roc_auc": "roc_auc real",
    "ml_average_precision": "pr_auc real",
    "ml_accuracy": "accuracy real, positive_rate real, n_rows bigint",
    "ml_metrics_with_unlabelled": "roc_auc real, pr_auc real, accuracy real, positive_rate real, n_rows bigint",
    "ml_metrics_by_state": "customer_state string, roc_auc real, pr_auc real, accuracy real, positive_rate real, n_rows bigint",
    "ml_no_leakage": "feature string, roc_auc real, forbidden_name boolean, passed boolean",
    "ml_quality_gate": "check_name string, threshold real, passed boolean, severity string, blocking boolean",
    "ml_metrics": "n_rows bigint, positive_rate real, passed boolean",
    "ml_scores": "order_id bigint, is_late_delivery bigint, in_bounds boolean",
    "ml_optimality": "coefficient string, gradient real",
    "ml_fingerprint": "fingerprint string",
}


def columns(name: str) -> list[tuple[str, str]]:
    text = CONTRACTS.get(name, CHECK_RESULT if name.startswith("dq_") else "")
    return [tuple(column.split()) for column in text.split(", ") if column]


def conform(name: str, df: DataFrame) -> DataFrame:
    """Columns, types and rounding of the contract."""
    return df.select(
        *[
            F.round(F.col(c).cast("double"), DIGITS[kind]).alias(c)
            if kind in DIGITS
            else F.col(c).cast(kind).alias(c)
            for c, kind in columns(name)
        ]
    )


def conform_sql(name: str, sql: str) -> str:
    picked = ", ".join(
        f"round(CAST({c} AS DOUBLE), {DIGITS[kind]}) AS {c}"
        if kind in DIGITS
        else f"CAST({c} AS {SQL_TYPES[kind]}) AS {c}"
        for c, kind in columns(name)
    )
    return f"SELECT {picked} FROM ({sql}) AS answer"
