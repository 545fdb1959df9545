"""One distribution of item rows by order, and orders too large for one task."""

from __future__ import annotations

import random
import re

import pytest
from fixtures import raw_tables
from tradewind.functions.skew import heavy_keys, null_is_heavy, split_keys
from tradewind.operators import intermediate, marts, staging
from tradewind.plans.warehouse import Warehouse

SCHEMA = "order_id int, product_id int, seller_id int, price double, freight_value double, item_total double"


def exchanges(df) -> int:
    """Shuffles of a plan; broadcasts and reused ones do not count."""
    return len(re.findall(r"(?<!Reused)(?<!Broadcast)Exchange (?:hash|range|single|Round)", df._jdf.queryExecution().executedPlan().toString()))


def items(seed=1, n=4000):
    rng = random.Random(seed)
    rows = []
    for _ in range(n):
        order = 7 if rng.random() < 0.34 else rng.choice([None, 9, *range(10, 400)])
        price, freight = rng.randint(1, 9000) / 100, rng.randint(0, 900) / 100
        rows.append((order, rng.choice([None, *range(60)]), rng.choice([None, *range(9)]), price, freight, price + freight))
    return rows


def answers(df):
    return sorted((tuple(round(v, 6) if isinstance(v, float) else v for v in r) for r in df.collect()), key=str)


def test_totals_of_heavy_orders_are_the_same(spark):
    df = spark.createDataFrame(items(), SCHEMA).repartition(5)
    plain = answers(intermediate.order_totals(df))
    assert answers(intermediate.order_totals(df, [7, 9, 100_000])) == plain
    seven = next(r for r in plain if r[0] == 7)
    own = [r for r in items() if r[0] == 7]
    assert seven[1:4] == (len(own), len({r[1] for r in own} - {None}), len({r[2] for r in own} - {None}))


def test_item_rows_are_exchanged_once(spark, tmp_path):
    spark.createDataFrame(items(), SCHEMA).write.parquet(str(tmp_path / "items"))
    df = spark.read.parquet(str(tmp_path / "items"))
    assert exchanges(intermediate.order_totals(df)) == 1


def test_a_heavy_order_spreads_over_tasks(spark):
    """No task of the heavy way holds more than a few of its rows once they left the scan."""
    rows = [(7, i % 5000, i % 97, 1.0, 0.5, 1.5) for i in range(20_000)]
    df = spark.createDataFrame(rows, SCHEMA).repartition(16)
    assert heavy_keys(df, "order_id", 10_000) == [7]
    row = intermediate.order_totals(df, [7]).first()
    assert (row.items_cnt, row.distinct_products_cnt, row.distinct_sellers_cnt) == (20_000, 5000, 97)
    plan = intermediate.order_totals(df, [7])._jdf.queryExecution().executedPlan().toString()
    # Sums are partial before they move, and distinct counts move as (order, product) and (order, seller).
    assert re.search(r"hashpartitioning\(order_id#\d+, product_id#\d+", plan)
    assert re.search(r"hashpartitioning\(order_id#\d+, seller_id#\d+", plan)


@pytest.mark.parametrize("column, least, want", [("k", 100, [7]), ("k", 10**6, []), ("t", 100, ["x"])])
def test_heavy_keys_are_counted_exactly(spark, column, least, want):
    df = spark.range(3000).selectExpr("if(id % 3 = 0, 7, if(id % 3 = 1, NULL, id)) AS k", "if(id % 2 = 0, 'x', NULL) AS t")
    assert heavy_keys(df, column, least) == want
    assert heavy_keys(df, column, 1501) == []
    assert heavy_keys(df.where("false"), column, 1) == []


def facts(tables, heavy=()):
    names = ("stg_order_items", "stg_orders", "stg_customers", "stg_sellers", "stg_geolocation")
    return intermediate.order_item_facts(*[tables[n] for n in names], heavy)


def test_facts_of_heavy_orders_are_the_same(spark, tmp_path):
    tables = Warehouse(spark, raw_tables(spark), folder=str(tmp_path)).tables()
    plain = answers(facts(tables))
    orders = [r[0] for r in plain]
    assert len(orders) == len(set(orders)) > 3
    assert answers(facts(tables, orders[:2])) == plain and answers(facts(tables, orders)) == plain
    assert answers(intermediate.int_order_distance(facts(tables))) == answers(tables["int_order_distance"])


def test_the_wide_order_table_shuffles_little(spark):
    house = Warehouse.from_tpch(spark, "/root/testdata/sf0.001")
    for name in ("stg_orders", "stg_customers", "stg_order_payments", "stg_order_reviews"):
        house._tables[name] = house.write(name, house.table(name))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # as for tables of any size
    try:
        assert exchanges(house.define("int_orders_enriched")) <= 9
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert exchanges(house.define("int_orders_enriched")) <= 6


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


PAYMENTS = "order_id int, payment_sequential int, payment_type string, payment_installments int, payment_value double"


def payments(seed=2, n=3000):
    rng = random.Random(seed)
    kinds = [None, "boleto", "credit_card", "voucher"]
    return [
        (rng.choice([None, 7, *range(300)]), i, rng.choice(kinds), rng.choice([None, 1, 4]), rng.choice([None, *range(9)]))
        for i in range(n)
    ]


def test_sets_of_an_order_are_made_in_sorted_order(spark, tmp_path):
    """Hashing gives sets up after 128 keys and then sorts all rows with their unfinished sets, which spills."""
    spark.createDataFrame(items(), SCHEMA).write.parquet(str(tmp_path / "items"))
    rows = spark.read.parquet(str(tmp_path / "items"))
    assert "ObjectHashAggregate" not in plan_of(intermediate.order_totals(rows))
    tables = Warehouse(spark, raw_tables(spark), folder=str(tmp_path / "house")).tables()
    assert "ObjectHashAggregate" not in plan_of(facts(tables))
    got = {r[0]: r[1:4] for r in answers(intermediate.order_totals(rows))}
    for order in {r[0] for r in items()}:
        own = [r for r in items() if r[0] == order]
        assert got[order] == (len(own), len({r[1] for r in own} - {None}), len({r[2] for r in own} - {None}))


def test_payments_are_exchanged_once(spark, tmp_path):
    rows = [(o, i, t, n, None if v is None else float(v)) for o, i, t, n, v in payments()]
    spark.createDataFrame(rows, PAYMENTS).write.parquet(str(tmp_path / "payments"))
    df = spark.read.parquet(str(tmp_path / "payments"))
    plain = staging.stg_order_payments(df)
    assert exchanges(plain) == 1 and "ObjectHashAggregate" not in plan_of(plain)
    assert answers(staging.stg_order_payments(df, [7, 9, None])) == answers(plain)
    own = [r for r in rows if r[0] == 7]
    best = min((-r[4], r[2] is None, r[2] or "") for r in own if r[4] is not None)
    seven = next(r for r in answers(plain) if r[0] == 7)
    total = sum(r[4] for r in own if r[4] is not None)
    assert seven[1:] == (total, len(own), 4, best[2] or None, ", ".join(sorted({r[2] for r in own} - {None})))


def test_orders_without_a_key_are_heavy_if_many(spark):
    df = spark.range(100).selectExpr("if(id % 4 = 0, NULL, id) AS k")
    assert null_is_heavy(df, "k", 25) and not null_is_heavy(df, "k", 26)
    assert [part.count() for part in split_keys(df, "k", [None, 1])] == [74, 26]
    assert [part.count() for part in split_keys(df, "k", [1])] == [99, 1]
    assert [part.count() for part in split_keys(df, "k", [])] == [100, 0]


def test_sellers_points_are_a_written_dimension(spark, tmp_path):
    """Item rows meet them without an exchange as soon as their file is small, and move once, by order."""
    house = Warehouse(spark, raw_tables(spark), folder=str(tmp_path))
    for name in ("stg_order_items", "stg_orders", "stg_customers"):
        house._tables[name] = house.write(name, house.table(name))
    plan = plan_of(house.define("int_order_facts"))
    assert "int_seller_points" in house._tables
    assert not re.search(r"Exchange hashpartitioning\((seller_id|known_seller)#", plan)


def test_item_measures_do_not_travel(spark, tmp_path):
    house = Warehouse(spark, raw_tables(spark), folder=str(tmp_path))
    top, _, below = plan_of(house.define("int_order_items_enriched")).partition("Join")
    assert "AS price_segment" in top and "AS price_segment" not in below and "AS item_total" not in below


def test_items_of_the_product_dims_are_exchanged_once(spark, tmp_path):
    spark.createDataFrame(items(), SCHEMA).write.parquet(str(tmp_path / "items"))
    df = spark.read.parquet(str(tmp_path / "items"))
    goods = "product_id int, product_category_name_english string, product_weight_g double, product_volume_cm3 double"
    known = [(i, f"c{i % 5}" if i % 7 else None, None if i % 11 == 0 else i * 10.0, i * 2.0) for i in range(50)]
    spark.createDataFrame(known, goods).write.parquet(str(tmp_path / "products"))
    products = spark.read.parquet(str(tmp_path / "products"))  # a written dimension, whose size is known
    plain = marts.order_product_dims(df, products)
    assert exchanges(plain) == 1
    assert answers(marts.order_product_dims(df, products, [7, 9, None])) == answers(plain)
    by_id = {r[0]: r for r in known}
    for order, category, weight, volume, heaviest in answers(plain):
        own = [(r[3], by_id.get(r[1], (None,) * 4)) for r in items() if r[0] == order]
        worth = {}
        for price, product in own:
            worth[product[1] or "unknown"] = worth.get(product[1] or "unknown", 0) + price
        assert category == min(worth, key=lambda c: (-round(worth[c], 6), c))
        weights = [p[2] or 0.0 for _, p in own]
        assert (weight, volume, heaviest) == (sum(weights), sum(p[3] or 0.0 for _, p in own), max(weights))
