"""The registered queries as DuckDB SQL over the same parquet tables, for comparison.

Written against the definitions of the tables, independently of the Spark plans. Each entry of
``RELATIONS`` is one named relation; a query takes the relations it needs as common table expressions.
"""

from __future__ import annotations

import json
import re

from tradewind.ml.dataset import FEATURES, NUMERIC
from tradewind.plans.contracts import CONTRACTS, conform_sql
from tradewind.plans.warehouse import CHECKED, DATASETS
from tradewind.quality import catalogue

CENTS = "CAST(round(l_extendedprice * 100) AS BIGINT)"
LINE_ID = (
    f"CAST('0x' || substr(md5(concat_ws('|', l_linenumber, l_partkey, l_suppkey, {CENTS},"
    " CAST(l_shipdate AS DATE))), 1, 15) AS BIGINT)"
)


def rate(part: str, whole: str) -> str:
    hit, base = f"count(*) FILTER ({part})", f"count(*) FILTER ({whole})"
    return f"round(CASE WHEN {base} > 0 THEN CAST(100 AS DOUBLE) * {hit} / {base} END, 2)"


LATE = rate("is_late_delivery = 1", "is_delivered = 1")
BAD = rate("is_bad_review = 1", "has_review = 1")
LARGE = rate("is_large_order = 1", "true")
AVG_ORDER_VALUE, AVG_PRICE = (
    f"sum(CAST(round({c} * 100) AS BIGINT))::DOUBLE / nullif(count({c}), 0) / 100" for c in ("order_value", "price")
)
DELIVERED = "count(*) FILTER (is_delivered = 1)"

RELATIONS = {
    # Raw tables
    "raw_orders": """
        SELECT o_orderkey AS order_id, o_orderkey AS customer_id,
            CASE WHEN o_orderstatus = 'F' THEN 'delivered' WHEN o_orderstatus = 'O' THEN 'shipped'
                 WHEN o_orderkey % 5 = 0 THEN 'canceled' ELSE 'processing' END AS order_status,
            o_orderdate + to_hours(o_orderkey % 24) AS order_purchase_timestamp,
            o_orderdate + to_hours(o_orderkey % 24 + o_orderkey % 12) AS order_approved_at,
            CASE WHEN o_orderstatus <> 'P' THEN o_orderdate + to_days(CAST(1 + o_orderkey % 3 AS INTEGER))
                END AS order_delivered_carrier_date,
            CASE WHEN o_orderstatus <> 'P' THEN o_orderdate + to_hours(o_orderkey % 24)
                + to_days(CAST(3 + o_orderkey * 7 % 25 AS INTEGER)) END AS order_delivered_customer_date,
            o_orderdate + to_days(CAST(10 + o_orderkey % 21 AS INTEGER)) AS order_estimated_delivery_date
        FROM orders""",
    "raw_customers": """
        SELECT o_orderkey AS customer_id, c_custkey AS customer_unique_id,
            c_nationkey * 10 + c_custkey % 10 AS customer_zip_code_prefix,
            'CITY_' || c_custkey % 10 AS customer_city, n_name AS customer_state
        FROM orders JOIN customer ON c_custkey = o_custkey JOIN nation ON n_nationkey = c_nationkey""",
    "raw_order_items": f"""
        SELECT l_orderkey AS order_id, {LINE_ID} AS order_item_id, l_partkey AS product_id,
            l_suppkey AS seller_id, l_shipdate AS shipping_limit_date,
            ({CENTS} * (100 - CAST(round(l_discount * 100) AS BIGINT)) // 20000) / 100.0 AS price,
            ({CENTS} * CAST(round(l_tax * 100) AS BIGINT) // 20000) / 100.0 AS freight_value
        FROM lineitem""",
    "raw_order_payments": f"""
        SELECT l_orderkey AS order_id, {LINE_ID} AS payment_sequential,
            CASE l_returnflag WHEN 'A' THEN 'credit_card' WHEN 'N' THEN 'boleto' WHEN 'R' THEN 'voucher'
                END AS payment_type,
            l_linenumber AS payment_installments, l_extendedprice AS payment_value
        FROM lineitem""",
    "raw_order_reviews": """
        SELECT event_id AS review_id,
            (user_id * 97 + event_id) % (SELECT count(*) FROM orders) AS order_id,
            CASE event_type WHEN 'purchase' THEN 5 WHEN 'signup' THEN 4 WHEN 'view' THEN 3
                WHEN 'click' THEN 2 WHEN 'error' THEN 1 END AS review_score,
            CASE WHEN event_id % 3 = 0 THEN event_type END AS review_comment_title,
            CASE event_id % 4 WHEN 0 THEN '' WHEN 1 THEN NULL ELSE props END AS review_comment_message,
            ts - to_hours(event_id % 48) AS review_creation_date, ts AS review_answer_timestamp
        FROM events""",
    "raw_sellers": """
        SELECT s_suppkey AS seller_id, s_nationkey * 10 + s_suppkey % 10 AS seller_zip_code_prefix,
            'CITY_' || s_suppkey % 10 AS seller_city, n_name AS seller_state
        FROM supplier JOIN nation ON n_nationkey = s_nationkey""",
    "raw_products": """
        SELECT p_partkey AS product_id,
            CASE WHEN p_partkey % 50 <> 0 THEN p_type END AS product_category_name,
            CASE WHEN p_partkey % 41 <> 0 THEN CAST(p_size * 100 AS DOUBLE) END AS product_weight_g,
            CAST(p_size AS DOUBLE) AS product_length_cm, CAST(p_size % 10 + 1 AS DOUBLE) AS product_height_cm,
            CAST(p_size % 7 + 2 AS DOUBLE) AS product_width_cm, CAST(p_size % 5 AS DOUBLE) AS product_photos_qty
        FROM part""",
    "raw_geolocation": """
        SELECT c_nationkey * 10 + c_custkey % 10 AS geolocation_zip_code_prefix,
            CAST(c_custkey % 50 - 40 AS DOUBLE) AS geolocation_lat,
            CAST(c_custkey % 53 - 80 AS DOUBLE) AS geolocation_lng,
            'CITY_' || c_custkey % 10 AS geolocation_city, n_name AS geolocation_state
        FROM customer JOIN nation ON n_nationkey = c_nationkey""",
    "raw_translation": """
        SELECT DISTINCT p_type AS name, lower(p_type) || '_goods' AS english FROM part WHERE p_type <> 'PROMO'""",
    "raw_state_region": """
        SELECT n_name AS state_code, n_name AS state_name, r_name AS region
        FROM nation JOIN region ON r_regionkey = n_regionkey""",
    # Staging
    "stg_customers": "SELECT * FROM raw_customers",
    "stg_geolocation": """
        SELECT geolocation_zip_code_prefix AS zip_code_prefix, avg(geolocation_lat) AS latitude,
            avg(geolocation_lng) AS longitude, min(geolocation_city) AS city,
            min(geolocation_state) AS state, count(*) AS points_cnt
        FROM raw_geolocation
        WHERE geolocation_lat >= -34 AND geolocation_lat <= 6
            AND geolocation_lng >= -74 AND geolocation_lng <= -34
        GROUP BY ALL""",
    "stg_order_items": """
        SELECT *, price + freight_value AS item_total,
            freight_value / nullif(price + freight_value, 0) AS freight_share,
            CASE WHEN price >= 300 THEN 'VERY_HIGH' WHEN price >= 100 THEN 'HIGH'
                WHEN price >= 30 THEN 'MEDIUM' WHEN price IS NOT NULL THEN 'LOW' ELSE 'UNKNOWN'
                END AS price_segment
        FROM raw_order_items""",
    "stg_order_payments": """
        SELECT order_id, sum(payment_value) AS payment_total, count(*) AS payments_cnt,
            max(payment_installments) AS max_installments,
            min(payment_type) FILTER (payment_value = largest) AS main_payment_type,
            array_to_string(list_sort(list_distinct(list(payment_type))), ', ') AS payment_types
        FROM raw_order_payments
            JOIN (SELECT order_id, max(payment_value) AS largest FROM raw_order_payments GROUP BY order_id)
            USING (order_id)
        GROUP BY order_id""",
    "stg_order_reviews": """
        SELECT *, CAST(review_score IN (1, 2) AS INTEGER) AS is_bad_review,
            CAST(review_score IN (4, 5) AS INTEGER) AS is_good_review,
            CAST(length(coalesce(review_comment_message, '')) > 0 AS INTEGER) AS has_comment
        FROM raw_order_reviews
        QUALIFY row_number() OVER (PARTITION BY order_id
            ORDER BY review_answer_timestamp DESC NULLS LAST, review_id) = 1""",
    "stg_orders": """
        SELECT *, CAST(order_purchase_timestamp AS DATE) AS order_purchase_date,
            hour(order_purchase_timestamp) AS order_hour, isodow(order_purchase_timestamp) AS order_dow,
            CAST(order_delivered_customer_date IS NOT NULL AS INTEGER) AS is_delivered,
            CAST(coalesce(order_status IN ('canceled', 'unavailable'), false) AS INTEGER) AS is_canceled,
            CAST(CAST(order_delivered_customer_date AS DATE) > CAST(order_estimated_delivery_date AS DATE)
                AS INTEGER) AS is_late_delivery,
            date_diff('day', order_purchase_timestamp, order_delivered_customer_date) AS delivery_days,
            date_diff('day', order_estimated_delivery_date, order_delivered_customer_date)
                AS delivery_delay_days
        FROM raw_orders""",
    "stg_products": """
        SELECT product_id, ifnull(product_category_name, 'unknown') AS product_category_name,
            ifnull(english, 'unknown') AS product_category_name_english, product_weight_g, product_length_cm,
            product_height_cm, product_width_cm, product_photos_qty,
            product_length_cm * product_height_cm * product_width_cm AS product_volume_cm3
        FROM raw_products LEFT JOIN raw_translation ON name = product_category_name""",
    "stg_sellers": "SELECT * FROM raw_sellers",
    # Intermediate
    "order_totals": """
        SELECT order_id, count(*) AS items_cnt, count(DISTINCT product_id) AS distinct_products_cnt,
            count(DISTINCT seller_id) AS distinct_sellers_cnt, sum(price) AS items_value,
            sum(freight_value) AS freight_value, sum(item_total) AS order_value
        FROM stg_order_items GROUP BY order_id""",
    "int_order_distance": """
        SELECT it.order_id, min(12742 * asin(sqrt(least(1.0,
            pow(sin(radians(sp.latitude - cp.latitude) / 2), 2) + cos(radians(cp.latitude))
            * cos(radians(sp.latitude)) * pow(sin(radians(sp.longitude - cp.longitude) / 2), 2)
            )))) FILTER (sp.latitude IS NOT NULL AND cp.latitude IS NOT NULL) AS customer_seller_distance_km
        FROM stg_order_items AS it JOIN stg_orders USING (order_id) JOIN stg_customers USING (customer_id)
            JOIN stg_sellers USING (seller_id)
            LEFT JOIN stg_geolocation AS cp ON cp.zip_code_prefix = customer_zip_code_prefix
            LEFT JOIN stg_geolocation AS sp ON sp.zip_code_prefix = seller_zip_code_prefix
        GROUP BY it.order_id""",
    "int_orders_enriched": """
        SELECT od.*, cu.customer_unique_id, cu.customer_state, cu.customer_city, rg.region AS customer_region,
            ifnull(tot.items_cnt, 0) AS items_cnt, ifnull(tot.distinct_products_cnt, 0) AS distinct_products_cnt,
            ifnull(tot.distinct_sellers_cnt, 0) AS distinct_sellers_cnt,
            ifnull(tot.items_value, 0) AS items_value, ifnull(tot.freight_value, 0) AS freight_value,
            ifnull(tot.order_value, 0) AS order_value,
            CASE WHEN tot.order_value >= 300 THEN 'VERY_HIGH' WHEN tot.order_value >= 100 THEN 'HIGH'
                WHEN tot.order_value >= 30 THEN 'MEDIUM' ELSE 'LOW' END AS order_value_segment,
            CASE WHEN tot.order_value >= 200 THEN 1 ELSE 0 END AS is_large_order,
            pay.payment_total, pay.main_payment_type, pay.max_installments,
            rev.review_score, rev.is_bad_review, rev.is_good_review,
            CAST(rev.order_id IS NOT NULL AS INTEGER) AS has_review, dist.customer_seller_distance_km
        FROM stg_orders AS od JOIN stg_customers AS cu USING (customer_id)
            LEFT JOIN order_totals AS tot ON tot.order_id = od.order_id
            LEFT JOIN stg_order_payments AS pay ON pay.order_id = od.order_id
            LEFT JOIN stg_order_reviews AS rev ON rev.order_id = od.order_id
            LEFT JOIN int_order_distance AS dist ON dist.order_id = od.order_id
            LEFT JOIN raw_state_region AS rg ON rg.state_code = cu.customer_state""",
    "int_order_items_enriched": """
        SELECT it.order_id, it.order_item_id, it.price, it.freight_value, it.item_total, it.freight_share,
            it.price_segment, pr.product_id, pr.product_category_name, pr.product_category_name_english,
            pr.product_weight_g, pr.product_volume_cm3, se.seller_id, se.seller_state, se.seller_city,
            rg.region AS seller_region, od.* EXCLUDE (order_id, freight_value)
        FROM stg_order_items AS it JOIN int_orders_enriched AS od ON od.order_id = it.order_id
            LEFT JOIN stg_products AS pr ON pr.product_id = it.product_id
            LEFT JOIN stg_sellers AS se ON se.seller_id = it.seller_id
            LEFT JOIN raw_state_region AS rg ON rg.state_code = se.seller_state""",
    # Marts
    "mart_daily_state_metrics": f"""
        SELECT order_purchase_date, customer_state, min(customer_region) AS customer_region,
            count(*) AS orders_cnt, count(DISTINCT customer_unique_id) AS unique_customers,
            sum(order_value) AS total_revenue, {AVG_ORDER_VALUE} AS avg_order_value,
            quantile_cont(order_value, 0.95) AS p95_order_value, {LARGE} AS large_order_share,
            {DELIVERED} AS delivered_cnt, {LATE} AS late_delivery_rate, {BAD} AS bad_review_rate,
            avg(delivery_days) AS avg_delivery_days
        FROM int_orders_enriched GROUP BY order_purchase_date, customer_state""",
    "mart_delivery_quality_by_category": f"""
        SELECT product_category_name_english, min(product_category_name) AS product_category_name_pt,
            count(*) AS items_cnt, count(DISTINCT order_id) AS orders_cnt,
            count(DISTINCT seller_id) AS sellers_cnt, sum(item_total) AS total_revenue,
            {AVG_PRICE} AS avg_price, quantile_cont(price, 0.95) AS p95_price,
            avg(freight_share) AS avg_freight_share, {DELIVERED} AS delivered_cnt,
            {LATE} AS late_delivery_rate, avg(delivery_days) AS avg_delivery_days,
            {BAD} AS bad_review_rate, avg(review_score) AS avg_review_score
        FROM int_order_items_enriched GROUP BY product_category_name_english""",
    "mart_delivery_quality_by_state": f"""
        SELECT customer_state, min(customer_region) AS customer_region, count(*) AS orders_cnt,
            count(DISTINCT customer_unique_id) AS unique_customers,
            sum(distinct_sellers_cnt) AS seller_links_cnt, sum(order_value) AS total_revenue,
            {AVG_ORDER_VALUE} AS avg_order_value, sum(freight_value) AS total_freight,
            round(100 * sum(freight_value) / nullif(sum(order_value), 0), 2) AS freight_share_pct,
            {DELIVERED} AS delivered_cnt, {LATE} AS late_delivery_rate,
            avg(delivery_days) AS avg_delivery_days,
            quantile_cont(CAST(delivery_days AS DOUBLE), 0.95) AS p95_delivery_days,
            {BAD} AS bad_review_rate, avg(review_score) AS avg_review_score,
            avg(customer_seller_distance_km) AS avg_distance_km
        FROM int_orders_enriched GROUP BY customer_state""",
    "mart_hourly_order_pattern": f"""
        SELECT order_dow, order_hour,
            (['Понедельник', 'Вторник', 'Среда', 'Четверг', 'Пятница', 'Суббота', 'Воскресенье'])[order_dow]
                AS dow_name,
            CAST(order_dow IN (6, 7) AS INTEGER) AS is_weekend, count(*) AS orders_cnt,
            count(DISTINCT customer_unique_id) AS unique_customers, sum(order_value) AS total_revenue,
            {AVG_ORDER_VALUE} AS avg_order_value, {LARGE} AS large_order_share,
            {DELIVERED} AS delivered_cnt, {LATE} AS late_delivery_rate, {BAD} AS bad_review_rate,
            {rate("is_canceled = 1", "true")} AS cancel_rate
        FROM int_orders_enriched GROUP BY order_dow, order_hour""",
    "mart_customer_value_profile": f"""
        SELECT customer_unique_id, min(customer_state) AS customer_state,
            min(customer_region) AS customer_region, count(*) AS orders_cnt, sum(order_value) AS total_spend,
            {AVG_ORDER_VALUE} AS avg_order_value, max(order_value) AS max_order_value,
            min(order_purchase_date) AS first_order_date, max(order_purchase_date) AS last_order_date,
            max(max(order_purchase_date)) OVER () - max(order_purchase_date) AS recency_days,
            ifnull(sum(is_late_delivery), 0) AS late_orders_cnt, ifnull(sum(is_bad_review), 0) AS bad_reviews_cnt,
            sum(is_canceled) AS canceled_orders_cnt, sum(has_review) AS reviewed_orders_cnt,
            avg(review_score) AS avg_review_score, CAST(count(*) > 1 AS INTEGER) AS is_repeat_customer,
            CASE WHEN sum(order_value) < 150 THEN 'LOW' WHEN sum(order_value) < 500 THEN 'MEDIUM'
                ELSE 'HIGH' END AS value_segment
        FROM int_orders_enriched GROUP BY customer_unique_id""",
    "mart_seller_analytics": f"""
        SELECT *, CASE WHEN orders_cnt >= 10 AND late_delivery_rate > 20 THEN 1 ELSE 0 END AS is_underperforming
        FROM (
            SELECT seller_id, min(seller_state) AS seller_state, min(seller_city) AS seller_city,
                min(seller_region) AS seller_region, count(*) AS items_sold,
                count(DISTINCT order_id) AS orders_cnt, count(DISTINCT product_id) AS unique_products,
                count(DISTINCT product_category_name_english) AS unique_categories,
                string_agg(DISTINCT product_category_name_english, ', '
                    ORDER BY product_category_name_english) AS categories,
                count(DISTINCT customer_state) AS states_served, sum(item_total) AS total_revenue,
                {AVG_PRICE} AS avg_price, sum(freight_value) AS total_freight, {DELIVERED} AS delivered_cnt,
                {LATE} AS late_delivery_rate, avg(delivery_days) AS avg_delivery_days,
                sum(has_review) AS reviewed_cnt, {BAD} AS bad_review_rate,
                avg(review_score) AS avg_review_score, avg(customer_seller_distance_km) AS avg_distance_km
            FROM int_order_items_enriched GROUP BY seller_id)""",
    "order_product_dims": """
        SELECT order_id, arg_min(category, (-value, category)) AS main_product_category,
            sum(weight) AS total_weight_g, sum(volume) AS total_volume_cm3, max(heaviest) AS max_item_weight_g
        FROM (
            SELECT order_id, ifnull(product_category_name_english, 'unknown') AS category, sum(price) AS value,
                sum(ifnull(product_weight_g, 0)) AS weight, sum(ifnull(product_volume_cm3, 0)) AS volume,
                max(ifnull(product_weight_g, 0)) AS heaviest
            FROM stg_order_items LEFT JOIN stg_products USING (product_id) GROUP BY ALL)
        GROUP BY order_id""",
    "mart_order_features": """
        SELECT od.* EXCLUDE (main_payment_type, max_installments),
            od.freight_value / nullif(od.order_value, 0) AS freight_share,
            ifnull(od.main_payment_type, 'unknown') AS main_payment_type,
            ifnull(od.max_installments, 0) AS max_installments,
            month(order_purchase_timestamp) AS purchase_month,
            date_diff('day', order_purchase_timestamp, order_estimated_delivery_date)
                AS estimated_delivery_span_days,
            ifnull(main_product_category, 'unknown') AS main_product_category,
            ifnull(total_weight_g, 0) AS total_weight_g, ifnull(total_volume_cm3, 0) AS total_volume_cm3,
            ifnull(max_item_weight_g, 0) AS max_item_weight_g
        FROM int_orders_enriched AS od LEFT JOIN order_product_dims USING (order_id)""",
    "daily_orders": """
        SELECT order_date, count(order_id) AS orders_cnt, ifnull(sum(is_canceled), 0) AS canceled_cnt
        FROM (SELECT CAST(unnest(generate_series(min(order_purchase_date), max(order_purchase_date),
                INTERVAL 1 DAY)) AS DATE) AS order_date FROM stg_orders)
            LEFT JOIN stg_orders ON order_purchase_date = order_date
        GROUP BY order_date""",
}


def daily_series(keys: str, shared: bool = False) -> str:
    """Orders per day of every combination of ``keys``, days without orders included."""
    ends = "(SELECT min(order_purchase_date) FROM int_orders_enriched), (SELECT max(order_purchase_date) FROM int_orders_enriched)"
    own = "min(order_purchase_date), max(order_purchase_date)"
    same = " AND ".join(f"o.{k} IS NOT DISTINCT FROM d.{k}" for k in keys.split(", "))
    return f"""
        SELECT {", ".join(f"d.{k}" for k in keys.split(", "))}, order_date, count(order_id) AS orders_cnt,
            ifnull(sum(is_canceled), 0) AS canceled_cnt
        FROM (SELECT {keys}, CAST(unnest(generate_series({ends if shared else own}, INTERVAL 1 DAY)) AS DATE)
                AS order_date FROM int_orders_enriched WHERE order_purchase_date IS NOT NULL GROUP BY {keys}) AS d
            LEFT JOIN int_orders_enriched AS o ON o.order_purchase_date = d.order_date AND {same}
        GROUP BY ALL"""


def anomalies(days: int, threshold: float, series: str = "daily_orders", keys: str = "") -> str:
    by = f"PARTITION BY {keys} " if keys else ""
    return f"""
        SELECT *, CAST(ifnull(abs(z_score) >= {threshold}, false) AS INTEGER) AS is_anomaly,
            CASE WHEN z_score >= {threshold} THEN 'spike' WHEN z_score <= -{threshold} THEN 'drop'
                END AS anomaly_direction
        FROM (
            SELECT *, (orders_cnt - rolling_mean) / nullif(rolling_std, 0) AS z_score
            FROM (
                SELECT *, CASE WHEN count(*) OVER past = {days} THEN avg(orders_cnt) OVER past END AS rolling_mean,
                    CASE WHEN count(*) OVER past = {days} THEN stddev_samp(orders_cnt) OVER past END
                        AS rolling_std
                FROM {series}
                WINDOW past AS ({by}ORDER BY order_date ROWS BETWEEN {days} PRECEDING AND 1 PRECEDING)))"""


RELATIONS["mart_daily_order_anomalies"] = anomalies(7, 3.0)
RELATIONS["daily_orders_by_state"] = daily_series("customer_state")
RELATIONS["daily_orders_by_region"] = daily_series("customer_region")
RELATIONS["daily_orders_by_status"] = daily_series("customer_region, order_status", shared=True)

# --- training ------------------------------------------------------------------------------------

BUCKET = "CAST('0x' || substr(md5(order_id || '|split|42'), 1, 8) AS BIGINT) % 10000"
NUMERIC_DOUBLES = ", ".join(f"CAST({c} AS DOUBLE) AS {c}" for c in NUMERIC)

RELATIONS |= {
    "ml_features": f"""
        SELECT order_id, {NUMERIC_DOUBLES}, customer_state, main_payment_type, is_late_delivery
        FROM mart_order_features""",
    "labelled": f"SELECT *, {BUCKET} AS bucket FROM ml_features WHERE is_late_delivery IS NOT NULL",
    "train_rows": "SELECT * FROM labelled WHERE bucket >= 2000",
    "train_long": " UNION ALL ".join(
        f"SELECT '{c}' AS feature, {c} AS value, is_late_delivery AS label FROM train_rows" for c in NUMERIC
    ),
    "ml_medians": "SELECT feature, median(value) AS median FROM train_long GROUP BY feature",
    "scored": """
        SELECT '' AS grp, customer_state, is_late_delivery AS label, (order_id * 37 % 1000) / 1000.0 AS score
        FROM labelled""",
}


def metric_sql(rows: str, group: str, threshold: float = 0.5) -> str:
    """Metrics per group from windows over one row per score."""
    return f"""
        SELECT {group}, sum(pos * (neg_below + neg / 2.0)) / nullif(any_value(p) * any_value(n), 0) AS roc_auc,
            sum(CAST(pos AS DOUBLE) / nullif(p, 0) * hits / (hits + alarms)) AS pr_auc,
            sum(CASE WHEN score >= {threshold} THEN pos ELSE neg END) / CAST(any_value(p + n) AS DOUBLE) AS accuracy,
            any_value(p) / CAST(any_value(p + n) AS DOUBLE) AS positive_rate, any_value(p + n) AS n_rows
        FROM (
            SELECT *, CAST(sum(pos) OVER (PARTITION BY {group}) AS DOUBLE) AS p,
                CAST(sum(neg) OVER (PARTITION BY {group}) AS DOUBLE) AS n,
                CAST(sum(neg) OVER (PARTITION BY {group} ORDER BY score) - neg AS DOUBLE) AS neg_below,
                CAST(sum(pos) OVER (PARTITION BY {group} ORDER BY score DESC) AS DOUBLE) AS hits,
                CAST(sum(neg) OVER (PARTITION BY {group} ORDER BY score DESC) AS DOUBLE) AS alarms
            FROM (SELECT {group}, score, sum(label) AS pos, count(*) - sum(label) AS neg
                FROM ({rows}) GROUP BY ALL))
        GROUP BY {group}"""


SCALING = " UNION ALL ".join(
    f"""SELECT '{c}' AS feature, avg(v) AS mean, stddev_pop(v) AS std FROM (
        SELECT ifnull({c}, (SELECT median FROM ml_medians WHERE feature = '{c}')) AS v FROM train_rows)"""
    for c in NUMERIC
)
OVERALL = metric_sql("SELECT * FROM scored", "grp")
FINGERPRINT_JSON = json.dumps({"seed": 42, "test_frac": 0.2}, sort_keys=True)

ANSWERS = {name: f"SELECT * FROM {name}" for name in (*DATASETS, *RELATIONS) if name in CONTRACTS} | {
    "stg_orders_window": """SELECT * FROM stg_orders WHERE order_purchase_timestamp >= TIMESTAMP '1996-01-01'
        AND order_purchase_timestamp < TIMESTAMP '1997-01-01'""",
    "stg_orders_month_window": """SELECT * FROM stg_orders WHERE order_purchase_timestamp >= TIMESTAMP '1996-01-01'
        AND order_purchase_timestamp < TIMESTAMP '1997-01-01'""",
    "sink_backfilled_months": """SELECT strftime(order_purchase_timestamp, '%Y%m') AS purchase_ym, count(*) AS rows_cnt,
        count(*) FILTER (order_status = 'delivered') AS delivered_cnt FROM raw_orders
        WHERE order_status = 'delivered' OR order_purchase_timestamp < TIMESTAMP '1996-01-01'
            OR order_purchase_timestamp >= TIMESTAMP '1997-01-01' GROUP BY ALL""",
    "sink_published_sellers": """SELECT seller_state, count(*) AS sellers_cnt FROM stg_sellers
        WHERE seller_id % 2 = 0 GROUP BY ALL""",
    "raw_accounting": """SELECT count(*) FILTER (product_id % 97 <> 0) AS accepted, count(*) FILTER (product_id % 97 = 0)
        AS rejected, sum(product_length_cm) FILTER (product_id % 97 <> 0) AS accepted_length,
        sum(product_length_cm) FILTER (product_id % 97 = 0) AS rejected_length FROM raw_products""",
    "sink_monthly_partitions": """SELECT strftime(order_purchase_date, '%Y%m') AS purchase_ym,
        count(*) AS rows_cnt, sum(orders_cnt) AS orders_cnt, sum(total_revenue) AS total_revenue
        FROM mart_daily_state_metrics GROUP BY ALL""",
    "sink_train_holdout": """SELECT CASE WHEN bucket < 2000 THEN 'holdout' ELSE 'train' END AS part,
        count(*) AS rows_cnt, sum(is_late_delivery) AS late_cnt FROM labelled GROUP BY ALL""",
    "seller_price_percentiles": """SELECT seller_id, quantile_cont(price, 0.05) AS p05_price,
        median(price) AS median_price, quantile_cont(price, 0.95) AS p95_price
        FROM int_order_items_enriched GROUP BY seller_id""",
    "state_categories": """SELECT customer_state, string_agg(DISTINCT product_category_name_english, ', '
        ORDER BY product_category_name_english) AS categories FROM int_order_items_enriched GROUP BY ALL""",
    "class_balance": """SELECT round(avg(is_late_delivery), 4) AS positive_rate,
        count(is_late_delivery) AS known_cnt, count(*) - count(is_late_delivery) AS unknown_cnt
        FROM mart_order_features""",
    "price_segments": """SELECT price_segment, count(*) AS items_cnt,
        sum(freight_value) / sum(item_total) AS freight_share FROM stg_order_items GROUP BY ALL""",
    "order_calendar": """SELECT order_dow,
        (['Понедельник', 'Вторник', 'Среда', 'Четверг', 'Пятница', 'Суббота', 'Воскресенье'])[order_dow]
            AS dow_name,
        month(order_purchase_timestamp) AS purchase_month, order_hour, count(*) AS orders_cnt,
        avg(delivery_delay_days) AS avg_delay_days FROM stg_orders GROUP BY ALL""",
    "seller_state_distance": """SELECT seller_state, customer_state,
        min(customer_seller_distance_km) AS nearest_km, avg(customer_seller_distance_km) AS mean_km
        FROM int_order_items_enriched GROUP BY ALL""",
    "anomalies_short_window": anomalies(3, 2.0),
    "anomalies_by_state": anomalies(7, 3.0, "daily_orders_by_state", "customer_state"),
    "anomalies_by_status_shared_calendar": anomalies(
        3, 2.0, "daily_orders_by_status", "customer_region, order_status"
    ),
    "dq_reconciliation": """
        SELECT check_name, sum(bad) AS violations, sum(bad) = 0 AS passed FROM (
            SELECT 'delivery_after_purchase' AS check_name, count(*) AS bad FROM int_orders_enriched
            WHERE order_delivered_customer_date < order_purchase_timestamp OR delivery_days < 0
            UNION ALL
            SELECT 'no_negative_amounts', (SELECT count(*) FILTER (price < 0) + count(*) FILTER (freight_value < 0)
                FROM stg_order_items) + (SELECT count(*) FILTER (order_value < 0) FROM int_orders_enriched)
                + (SELECT count(*) FILTER (total_revenue < 0) FROM mart_daily_state_metrics)
                + (SELECT count(*) FILTER (total_revenue < 0) FROM mart_seller_analytics)
            UNION ALL
            SELECT 'order_revenue_reconciles', CAST(abs(mart_revenue - source_revenue)
                > source_revenue / 10000 AS INTEGER) FROM revenue
            UNION ALL
            SELECT 'rates_within_bounds', count(*) FILTER (v < 0 OR v > 100) FROM rates)
        GROUP BY check_name""",
    "dq_revenue_totals": "SELECT *, mart_revenue - source_revenue AS difference FROM revenue",
    "dq_rates": """SELECT model_name, metric_name, count(*) AS rates_cnt, count(*) - count(v) AS undefined_cnt,
        count(*) FILTER (v NOT BETWEEN 0 AND 100) AS out_of_bounds_cnt, max(v) AS max_rate
        FROM rates GROUP BY ALL""",
    "dq_negative_amounts": """
        SELECT 'stg_order_items.price' AS source_column, count(*) FILTER (price < 0) AS bad_cnt
            FROM stg_order_items
        UNION ALL SELECT 'stg_order_items.freight_value', count(*) FILTER (freight_value < 0)
            FROM stg_order_items
        UNION ALL SELECT 'int_orders_enriched.order_value', count(*) FILTER (order_value < 0)
            FROM int_orders_enriched
        UNION ALL SELECT 'mart_daily_state_metrics.total_revenue', count(*) FILTER (total_revenue < 0)
            FROM mart_daily_state_metrics
        UNION ALL SELECT 'mart_seller_analytics.total_revenue', count(*) FILTER (total_revenue < 0)
            FROM mart_seller_analytics""",
    "dq_freshness": """SELECT newest, seconds // 86400 AS age_days,
        CASE WHEN seconds > 7300 * 86400 THEN 'error' WHEN seconds > 3650 * 86400 THEN 'warn' ELSE 'pass' END AS status
        FROM (SELECT newest, CAST(epoch(TIMESTAMP '2011-07-31 11:00:00') - epoch(newest) AS BIGINT) AS seconds
            FROM (SELECT max(order_purchase_timestamp) AS newest FROM raw_orders))""",
    "dq_stored_failures": """SELECT customer_region, count(*) AS failing_cnt FROM int_orders_enriched
        WHERE customer_region NOT IN ('ASIA', 'EUROPE') GROUP BY ALL""",
    "dq_duplicate_lines": """SELECT order_id, payment_installments AS line_number, count(*) AS n_records
        FROM raw_order_payments GROUP BY ALL HAVING count(*) > 1""",
    "ml_split": f"""SELECT order_id, {BUCKET} AS bucket,
        CASE WHEN {BUCKET} < 2000 THEN 'holdout' ELSE 'train' END AS part FROM mart_order_features""",
    "ml_training_metadata": f"""SELECT count(*) FILTER (bucket >= 2000) AS rows_train,
        count(*) FILTER (bucket < 2000) AS rows_holdout, round(avg(is_late_delivery), 4) AS positive_rate,
        '{json.dumps(list(FEATURES))}' AS features FROM labelled""",
    "ml_scaling": SCALING,
    "ml_roc_auc": OVERALL,
    "ml_average_precision": OVERALL,
    "ml_accuracy": OVERALL,
    "ml_metrics_with_unlabelled": OVERALL,
    "ml_metrics": "SELECT count(*) AS n_rows, avg(is_late_delivery) AS positive_rate, true AS passed"
    " FROM labelled WHERE bucket < 2000",
    "ml_scores": "SELECT order_id, is_late_delivery, true AS in_bounds FROM labelled WHERE bucket < 2000",
    "ml_optimality": "SELECT coefficient, 0 AS gradient FROM (SELECT unnest(["
    + ", ".join(f"'{c}'" for c in ("intercept", *NUMERIC))
    + """]) AS coefficient UNION ALL SELECT DISTINCT 'customer_state=' || customer_state FROM train_rows
        UNION ALL SELECT DISTINCT 'main_payment_type=' || main_payment_type FROM train_rows)""",
    "ml_metrics_by_state": metric_sql("SELECT * FROM scored", "customer_state"),
    "ml_no_leakage": f"""SELECT feature, roc_auc, false AS forbidden_name,
        roc_auc < 0.99 AND roc_auc > 0.01 AS passed FROM ({metric_sql(
            "SELECT feature, round(value, 6) AS score, label FROM train_long WHERE value IS NOT NULL", "feature")})""",
    "ml_quality_gate": """SELECT 'quality_gate' AS check_name, 0.61 AS threshold, true AS passed,
        'error' AS severity, true AS blocking""",
    "raw_products_reloaded": "SELECT * FROM raw_products",
    "ml_fingerprint": f"""SELECT md5(concat_ws('|', count(*),
        sum(CAST('0x' || substr(md5(CAST(order_id AS VARCHAR)), 1, 15) AS BIGINT)), '#{FINGERPRINT_JSON}'))
        AS fingerprint FROM train_rows""",
}
RELATIONS["revenue"] = """
    SELECT (SELECT sum(total_revenue) FROM mart_daily_state_metrics) AS mart_revenue,
        (SELECT sum(price + freight_value) FROM stg_order_items) AS source_revenue"""
RELATIONS["rates"] = " UNION ALL ".join(
    f"SELECT '{table}' AS model_name, '{column}' AS metric_name, {column} AS v FROM {table}"
    for table, column in (
        ("mart_daily_state_metrics", "late_delivery_rate"),
        ("mart_daily_state_metrics", "bad_review_rate"),
        ("mart_daily_state_metrics", "large_order_share"),
        ("mart_delivery_quality_by_category", "late_delivery_rate"),
        ("mart_delivery_quality_by_category", "bad_review_rate"),
        ("mart_delivery_quality_by_state", "late_delivery_rate"),
        ("mart_delivery_quality_by_state", "freight_share_pct"),
        ("mart_hourly_order_pattern", "late_delivery_rate"),
        ("mart_hourly_order_pattern", "cancel_rate"),
        ("mart_seller_analytics", "late_delivery_rate"),
        ("mart_seller_analytics", "bad_review_rate"),
    )
)


# --- declared checks -----------------------------------------------------------------------------


def relation(table: str) -> str:
    """The relation behind a table of the check catalogue."""
    return {"seed_state_region": "raw_state_region"}.get(
        table, table if table.startswith(("stg_", "int_", "mart_")) else f"raw_{table}"
    )


def _quoted(value) -> str:
    return f"'{value}'" if isinstance(value, str) else str(value)


def violations_sql(check) -> str:
    source = relation(check.table)
    keys = ", ".join(check.columns)
    if check.kind == "not_null":
        return f"SELECT count(*) FROM {source} WHERE {keys} IS NULL"
    if check.kind == "accepted_values":
        return f"SELECT count(*) FROM {source} WHERE {keys} NOT IN ({', '.join(map(_quoted, check.values))})"
    if check.kind == "accepted_range":
        bounds = [f"{keys} < {check.low}"] if check.low is not None else []
        bounds += [f"{keys} > {check.high}"] if check.high is not None else []
        return f"SELECT count(*) FROM {source} WHERE {' OR '.join(bounds)}"
    if check.kind in ("unique", "unique_combination"):
        where = f"WHERE {keys} IS NOT NULL" if check.kind == "unique" else ""
        return f"SELECT count(*) FROM (SELECT {keys} FROM {source} {where} GROUP BY {keys} HAVING count(*) > 1)"
    if check.kind == "relationship":
        return (
            f"SELECT count(*) FROM {source} WHERE {keys} IS NOT NULL AND NOT EXISTS (SELECT 1 FROM"
            f" {relation(check.parent)} AS parent WHERE parent.{check.parent_column} = {source}.{keys})"
        )
    other = relation(check.parent)
    return f"SELECT CAST((SELECT count(*) FROM {source}) <> (SELECT count(*) FROM {other}) AS INTEGER)"


def checks_sql(table: str) -> str:
    parts = [
        f"SELECT '{c.table}' AS table_name, '{c.name}' AS check_name, '{c.severity}' AS severity,"
        f" {c.blocking} AS blocking, ({violations_sql(c)}) AS violations"
        for c in catalogue.declared(table)
    ]
    return f"SELECT *, violations = 0 AS passed FROM ({' UNION ALL '.join(parts)})"


RELATIONS["raw_product_category_name_translation"] = """
    SELECT name AS product_category_name, english AS product_category_name_english FROM raw_translation"""
ANSWERS |= {f"dq_{table}": checks_sql(table) for table in catalogue.CONTRACT}
ANSWERS["dq_failed_checks"] = "SELECT table_name, check_name, violations AS failing_cnt FROM ({}) WHERE violations > 0".format(
    " UNION ALL ".join(checks_sql(table) for table in CHECKED)
)


def _needed(sql: str) -> list[str]:
    """Relations a query names, directly or through others, in order of definition."""
    found: set[str] = set()
    waiting = [sql]
    while waiting:
        words = set(re.findall(r"\w+", waiting.pop()))
        for name in words & RELATIONS.keys() - found:
            found.add(name)
            waiting.append(RELATIONS[name])
    return [name for name in _ORDER if name in found]


def _definition_order() -> list[str]:
    """Relations, each after those it reads."""
    done: list[str] = []

    def visit(name: str) -> None:
        for other in set(re.findall(r"\w+", RELATIONS[name])) & RELATIONS.keys() - {name}:
            if other not in done:
                visit(other)
        if name not in done:
            done.append(name)

    for name in RELATIONS:
        visit(name)
    return done


_ORDER = _definition_order()


def oracle_sql() -> dict[str, str]:
    answers = {}
    for name, sql in ANSWERS.items():
        tables = ", ".join(f"{n} AS ({RELATIONS[n]})" for n in _needed(sql))
        answer = conform_sql(name, sql)
        answers[name] = f"WITH {tables} {answer}" if tables else answer
    return answers
