"""Queries over checks build no table that they do not read, and what several checks read they make once."""

from __future__ import annotations

from collections import Counter
from concurrent.futures import ThreadPoolExecutor

from fixtures import raw_tables
from tradewind.operators import intermediate
from tradewind.plans import registry
from tradewind.plans.warehouse import REREAD, SHARED, Warehouse
from tradewind.quality import catalogue, checks
from tradewind.sources import tpch


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_checks_build_only_what_they_read(spark, tmp_path):
    house = Warehouse(spark, raw_tables(spark), folder=str(tmp_path))
    registry.dq_stored_failures(house)
    assert "int_orders_enriched" in house._tables and not [n for n in house._tables if n.startswith("mart_")]
    registry.dq_negative_amounts(house)
    marts = {n for n in house._tables if n.startswith("mart_")}
    assert marts == {"mart_daily_state_metrics", "mart_seller_analytics"}


def test_failed_checks_of_all_tables_are_those_of_separate_checks(spark, tmp_path, monkeypatch):
    written = Counter()
    plain = Warehouse.write

    def spied(self, name, *rest):
        written[name] += 1
        return plain(self, name, *rest)

    monkeypatch.setattr(Warehouse, "write", spied)
    house = Warehouse(spark, raw_tables(spark), folder=str(tmp_path))

    def stored():
        return {(r.table_name, r.check_name): r.failing_cnt for r in registry.dq_failed_checks(house).collect()}

    first = stored()
    # Tables that checks and other tables read are written, once each, and not again by a second run.
    assert all("FileScan parquet" in plan_of(house.table(name)) for name in REREAD)
    assert stored() == first and set(written.values()) == {1} and REREAD | SHARED <= set(written)
    apart = checks.run_checks(catalogue.declared(), house.tables()).collect()
    assert first == {(r.table_name, r.check_name): r.violations for r in apart if not r.passed} and len(first) == 16


def test_failed_checks_after_other_queries_are_the_same(spark, tmp_path):
    """Tables that were written before carry no tags."""
    house = Warehouse(spark, raw_tables(spark), folder=str(tmp_path / "one"))
    house.build()
    other = Warehouse(spark, raw_tables(spark), folder=str(tmp_path / "other"))
    key = lambda df: sorted(map(tuple, df.collect()))
    assert key(registry.dq_failed_checks(house)) == key(registry.dq_failed_checks(other))


def test_a_repeated_order_stops_no_check(spark, tmp_path):
    raw = raw_tables(spark)
    raw["orders"] = raw["orders"].unionByName(raw["orders"].where("order_id = 'late'"))
    house = Warehouse(spark, raw, folder=str(tmp_path))
    got = {(r.table_name, r.check_name): r.failing_cnt for r in registry.dq_failed_checks(house).collect()}
    apart = checks.run_checks(catalogue.declared(), house.tables()).collect()
    assert got == {(r.table_name, r.check_name): r.violations for r in apart if not r.passed}
    assert got["orders", "unique_order_id"] == got["mart_order_features", "unique_order_id"] == 1


def test_keys_of_a_raw_and_its_staging_table_share_an_exchange(spark):
    raw = tpch.raw_tables(spark, "/root/testdata/sf0.001")
    # A line's number is never NULL, and the planner knows, so only the keys' check works it out.
    assert not raw["order_items"].schema["order_item_id"].nullable
    house = Warehouse.from_tpch(spark, "/root/testdata/sf0.001")
    names = ("order_items", "stg_order_items", "stg_orders", "stg_customers")
    keys = [c for name in names[:2] for c in catalogue.declared(name) if c.kind == "unique_combination"]
    found = checks.run_checks(keys, {name: house.table(name) for name in names})
    found.collect()
    assert len(keys) == 2 and "ReusedExchange" in plan_of(found)


def test_a_table_asked_for_side_by_side_is_made_once(spark, tmp_path, monkeypatch):
    written = []
    plain = Warehouse.write
    monkeypatch.setattr(Warehouse, "write", lambda self, name, *rest: written.append(name) or plain(self, name, *rest))
    house = Warehouse(spark, raw_tables(spark), folder=str(tmp_path))
    with ThreadPoolExecutor(6) as pool:
        some = list(pool.map(house.table, ["stg_products", "int_seller_points", "stg_products"] * 2))
    assert sorted(written) == ["int_seller_points", "stg_geolocation", "stg_products", "stg_sellers"]
    assert some[0] is some[2]


def test_distances_need_no_set_of_points(spark, tmp_path):
    tables = Warehouse(spark, raw_tables(spark), folder=str(tmp_path)).tables()
    names = ("stg_order_items", "stg_orders", "stg_customers", "stg_sellers", "stg_geolocation")
    plan = plan_of(intermediate.order_item_facts(*[tables[n] for n in names]))
    assert "transform(" not in plan and "lambdafunction" not in plan
