"""Checks that span tables. Each returns its failing rows."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

Tables = Mapping[str, DataFrame]

# The money columns and the percentage columns under check, and the share of revenue
# by which a mart may differ from its source through float summation.
MONEY = (
    ("stg_order_items", "price"),
    ("stg_order_items", "freight_value"),
    ("int_orders_enriched", "order_value"),
    ("mart_daily_state_metrics", "total_revenue"),
    ("mart_seller_analytics", "total_revenue"),
)
RATES = {
    "mart_daily_state_metrics": ("late_delivery_rate", "bad_review_rate", "large_order_share"),
    "mart_delivery_quality_by_category": ("late_delivery_rate", "bad_review_rate"),
    "mart_delivery_quality_by_state": ("late_delivery_rate", "freight_share_pct"),
    "mart_hourly_order_pattern": ("late_delivery_rate", "cancel_rate"),
    "mart_seller_analytics": ("late_delivery_rate", "bad_review_rate"),
}
REVENUE_TOLERANCE = 0.0001


def delivery_before_purchase(tables: Tables) -> DataFrame:
    delivered = F.col("order_delivered_customer_date")
    early = (delivered < F.col("order_purchase_timestamp")) | (F.col("delivery_days") < 0)
    return (
        tables["int_orders_enriched"]
        .where(delivered.isNotNull() & early)
        .select("order_id", "order_purchase_timestamp", "order_delivered_customer_date", "delivery_days")
    )


def negative_amounts(tables: Tables) -> DataFrame:
    parts = [
        tables[table]
        .where(F.col(column) < 0)
        .select(
            F.lit(f"{table}.{column}").alias("source_column"),
            F.col(column).cast("string").alias("bad_value"),
        )
        for table, column in MONEY
    ]
    return reduce(DataFrame.unionByName, parts)


def revenue_totals(tables: Tables) -> DataFrame:
    """Revenue of the daily mart beside that of the items: one row."""
    mart = tables["mart_daily_state_metrics"].agg(F.sum("total_revenue").alias("mart_revenue"))
    source = tables["stg_order_items"].agg(
        F.sum(F.col("price") + F.col("freight_value")).alias("source_revenue")
    )
    return mart.crossJoin(F.broadcast(source)).withColumn(
        "difference", F.col("mart_revenue") - F.col("source_revenue")
    )


def revenue_mismatch(tables: Tables) -> DataFrame:
    """A row when a join multiplied or lost orders on the way to the mart."""
    allowed = F.col("source_revenue") * REVENUE_TOLERANCE
    return revenue_totals(tables).where(F.abs("difference") > allowed)


def all_rates(tables: Tables) -> DataFrame:
    """Every percentage of the marts as (model_name, metric_name, metric_value)."""
    parts = [
        tables[table]
        .select(*columns)
        .unpivot([], list(columns), "metric_name", "metric_value")
        .select(F.lit(table).alias("model_name"), "metric_name", "metric_value")
        for table, columns in RATES.items()
    ]
    return reduce(DataFrame.unionByName, parts)


def rates_out_of_bounds(tables: Tables) -> DataFrame:
    return all_rates(tables).where((F.col("metric_value") < 0) | (F.col("metric_value") > 100))


CHECKS = {
    "delivery_after_purchase": delivery_before_purchase,
    "no_negative_amounts": negative_amounts,
    "order_revenue_reconciles": revenue_mismatch,
    "rates_within_bounds": rates_out_of_bounds,
}


def run(tables: Tables) -> DataFrame:
    """One row per check: check_name, violations, passed."""
    parts = [
        rows(tables)
        .agg(F.count(F.lit(1)).alias("violations"))
        .select(F.lit(name).alias("check_name"), "violations", (F.col("violations") == 0).alias("passed"))
        for name, rows in CHECKS.items()
    ]
    return reduce(DataFrame.unionByName, parts)
