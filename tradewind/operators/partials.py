"""Mergeable partial results of the wide tables, from which several marts are put together.

Each is one pass over a few columns of its wide table: sums per finest group, distinct (group, entity)
pairs, and (group, value, n) counts. Sums of sums, counts of pairs and percentiles of counts give the same
numbers as the wide table, so a mart reads partials only and coarser marts reuse those of finer ones. Means are
kept as a sum and a count, averages of money as whole cents.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, fields

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradewind.functions.expressions import count_if, pct, safe_div


def _is(name: str) -> Column:
    return count_if(F.col(name) == 1)


def _mean(name: str) -> dict[str, Column]:
    return {f"{name}_sum": F.sum(name), f"{name}_n": F.count(name)}


def _money(name: str) -> dict[str, Column]:
    return {f"{name}_cents": F.sum(F.round(F.col(name) * 100).cast("bigint")), f"{name}_n": F.count(name)}


RATES = {"delivered_cnt": "is_delivered", "late_cnt": "is_late_delivery", "reviewed_cnt": "has_review", "bad_cnt": "is_bad_review"}


def _measures(*parts: dict[str, Column]) -> list[Column]:
    rates = {name: _is(column) for name, column in RATES.items()}
    whole = {"rows_cnt": F.count(F.lit(1)), **rates}
    for part in parts:
        whole |= part
    return [column.alias(name) for name, column in whole.items()]


@dataclass(frozen=True)
class OrderPartials:
    """Partials of the wide order table, one row per order."""

    days: DataFrame  # sums per day, state and region
    customers: DataFrame  # distinct customers per day and state
    values: DataFrame  # order values per day and state, with their number
    delivery: DataFrame  # delivery days per state, with their number

    @classmethod
    def of(cls, orders: DataFrame) -> OrderPartials:
        days = orders.groupBy("order_purchase_date", "customer_state", "customer_region").agg(
            *_measures(
                {"large_cnt": _is("is_large_order"), "seller_links_cnt": F.sum("distinct_sellers_cnt")},
                {"revenue": F.sum("order_value"), "freight": F.sum("freight_value")},
                _money("order_value"),
                _mean("delivery_days"),
                _mean("review_score"),
                _mean("customer_seller_distance_km"),
            )
        )
        return cls(
            days,
            orders.select("order_purchase_date", "customer_state", "customer_unique_id").distinct(),
            value_counts(orders, ["order_purchase_date", "customer_state"], "order_value"),
            value_counts(orders, ["customer_state"], "delivery_days"),
        )


@dataclass(frozen=True)
class ItemPartials:
    """Partials of the wide item table, one row per item."""

    groups: DataFrame  # sums per category, its two names
    orders: DataFrame  # distinct orders per category
    sellers: DataFrame  # distinct sellers per category
    prices: DataFrame  # prices per category, with their number

    @classmethod
    def of(cls, items: DataFrame) -> ItemPartials:
        category = "product_category_name_english"
        groups = items.groupBy(category, "product_category_name").agg(
            *_measures(
                {"revenue": F.sum("item_total")},
                _money("price"),
                _mean("freight_share"),
                _mean("delivery_days"),
                _mean("review_score"),
            )
        )
        return cls(
            groups,
            items.select(category, "order_id").distinct(),
            items.select(category, "seller_id").distinct(),
            value_counts(items, [category], "price"),
        )


def value_counts(df: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """(keys, value, n): one row per distinct value, which percentiles and ranks need no more than."""
    kept = df.where(F.col(value).isNotNull())
    return kept.groupBy(*keys, F.col(value).cast("double").alias("value")).agg(F.count(F.lit(1)).alias("n"))


def merged(sums: DataFrame, keys: Sequence[str], labels: dict[str, str]) -> DataFrame:
    """Sums per ``keys``, coarser than those of ``sums``; ``labels`` are string minima of few rows."""
    names = [f.name for f in sums.schema.fields if f.dataType.simpleString() in ("bigint", "double")]
    added = [F.sum(n).alias(n) for n in names if n not in keys]
    return sums.groupBy(*keys).agg(*added, *[F.min(column).alias(name) for name, column in labels.items()])


def mean(name: str) -> Column:
    return safe_div(F.col(f"{name}_sum").cast("double"), F.col(f"{name}_n"))


def mean_money(name: str) -> Column:
    return safe_div(F.col(f"{name}_cents").cast("double"), F.col(f"{name}_n")) / 100


def share(part: str, whole: str) -> Column:
    return pct(F.col(part), F.col(whole))


def combined(first, second):
    """Partials of two disjoint sets of rows (two months, say) as those of all of them."""
    merged_fields = {}
    for f in fields(first):
        both = getattr(first, f.name).unionByName(getattr(second, f.name))
        if "n" in both.columns:  # counts of values
            both = both.groupBy(*[c for c in both.columns if c != "n"]).agg(F.sum("n").alias("n"))
        elif "rows_cnt" not in both.columns:  # pairs; sums are added up where they are merged
            both = both.distinct()
        merged_fields[f.name] = both
    return type(first)(**merged_fields)
