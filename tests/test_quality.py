"""Checks: failing rows, counts, catalogue, stored failures."""

from __future__ import annotations

from datetime import datetime, timedelta

import pytest
from fixtures import raw_tables
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from tradewind.plans.warehouse import Warehouse
from tradewind.quality import catalogue, checks, reconciliation
from tradewind.sources.schemas import RAW_SCHEMAS


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    return Warehouse(spark, raw_tables(spark), folder=str(tmp_path_factory.mktemp("house"))).tables()


@pytest.fixture
def one_table(frame):
    rows = [(1, 5.0, "a"), (1, None, "b"), (None, -1.0, "z"), (None, 101.0, None), (2, 100.0, "a")]
    return {"t": frame("id int, v double, s string", *rows), "p": frame("key int", (1,), (None,))}


@pytest.mark.parametrize(
    ("check", "violations"),
    [
        (checks.not_null("t", "id"), 2),
        (checks.unique("t", "id"), 1),
        (checks.unique_combination("t", ["id", "s"]), 0),
        (checks.unique_combination("t", ["id"]), 2),  # NULL is a value here
        (checks.accepted_values("t", "s", ["a", "b"]), 1),
        (checks.accepted_range("t", "v", 0, 100), 2),
        (checks.accepted_range("t", "v", 0, 100, inclusive=False), 3),
        (checks.accepted_range("t", "v", low=0), 1),
        (checks.accepted_range("t", "v", high=100), 1),
        (checks.relationship("t", "id", "p", "key"), 1),
        (checks.equal_rowcount("t", "p"), 1),
        (checks.equal_rowcount("t", "t"), 0),
    ],
)
def test_failing_rows_and_counts_agree(one_table, check, violations):
    assert checks.failing_rows(check, one_table).count() == violations
    row = checks.run_checks([check], one_table).first()
    assert (row.violations, row.passed) == (violations, violations == 0)


def test_relationship_counts_rows_not_keys(frame):
    tables = {"t": frame("id int", (7,), (7,), (7,), (1,)), "p": frame("key int", (1,))}
    check = checks.relationship("t", "id", "p", "key")
    assert checks.failing_rows(check, tables).count() == 3
    assert checks.run_checks([check], tables).first().violations == 3


def test_range_needs_a_bound():
    with pytest.raises(ValueError):
        checks.row_violation(checks.accepted_range("t", "v"))


def test_row_checks_of_a_table_share_one_scan(one_table):
    row_checks = [checks.not_null("t", "id"), checks.accepted_values("t", "s", ["a"]), checks.accepted_range("t", "v", 0)]
    plan = checks.check_table(row_checks, one_table)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Aggregate") == 1 and "Union" not in plan


def test_severity_and_blocking(one_table):
    results = checks.run_checks(
        [
            checks.not_null("t", "id", blocking=True),
            checks.not_null("t", "s", severity="warn", blocking=True),
            checks.not_null("t", "v"),
        ],
        one_table,
    )
    assert [r.check_name for r in checks.blocked(results).collect()] == ["not_null_id"]


def test_stored_failures(spark, one_table, tmp_path):
    path = checks.store_failures(checks.accepted_range("t", "v", 0, 100), one_table, str(tmp_path))
    assert path.endswith("test_failures/t_accepted_range_v")
    assert sorted(r.v for r in spark.read.parquet(path).collect()) == [-1.0, 101.0]


@pytest.mark.parametrize(("year", "status"), [(2019, "pass"), (2029, "warn"), (2039, "error")])
def test_freshness(tables, year, status):
    got = checks.freshness(tables["orders"], now=datetime(year, 1, 1), **catalogue.FRESHNESS).first()
    assert got.status == status


@pytest.mark.parametrize(
    ("days", "hours", "status"), [(3650, 0, "pass"), (3650, 12, "warn"), (7300, 0, "warn"), (7300, 12, "error")]
)
def test_freshness_counts_parts_of_days(spark, days, hours, status):
    newest = datetime(2018, 3, 1, 15)
    rows = spark.createDataFrame([(newest,), (None,)], "order_purchase_timestamp timestamp_ntz")
    clock = newest + timedelta(days=days, hours=hours)
    got = checks.freshness(rows, now=clock, **catalogue.FRESHNESS).first()
    assert (got.status, got.age_days) == (status, days)


def test_catalogue_is_complete_and_runs(tables):
    declared = catalogue.declared()
    assert len(declared) == 181  # with freshness: 182
    assert len({(c.table, c.name) for c in declared}) == 181
    failed = {
        (r.table_name, r.check_name): r.violations for r in checks.run_checks(declared, tables).collect() if not r.passed
    }
    # What the hand-made rows break on purpose.
    assert len(failed) == 16
    assert failed[("order_items", "not_null_price")] == 1
    assert failed[("stg_customers", "relationship_customer_state_seed_state_region")] == 2
    assert failed[("int_order_items_enriched", "not_null_seller_id")] == 1
    assert ("int_orders_enriched", "equal_rowcount_stg_orders") not in failed
    assert ("stg_orders", "unique_order_id") not in failed


def test_the_one_warning_of_the_catalogue():
    assert [c.name for c in catalogue.declared() if c.severity == "warn"] == [
        "accepted_range_estimated_delivery_span_days"
    ]


def test_reconciliation_passes_on_consistent_tables(tables):
    got = {r.check_name: r.violations for r in reconciliation.run(tables).collect()}
    assert got == {
        "delivery_after_purchase": 0,
        "no_negative_amounts": 0,
        "order_revenue_reconciles": 0,
        "rates_within_bounds": 0,
    }


def test_reconciliation_finds_what_it_should(tables):
    doubled = dict(tables)
    mart = tables["mart_daily_state_metrics"]
    doubled["mart_daily_state_metrics"] = mart.unionByName(mart)
    assert reconciliation.revenue_mismatch(doubled).count() == 1
    broken = dict(tables)
    broken["mart_seller_analytics"] = tables["mart_seller_analytics"].withColumns(
        {"late_delivery_rate": F.lit(100.5), "total_revenue": F.lit(-1.0)}
    )
    assert {r.model_name for r in reconciliation.rates_out_of_bounds(broken).collect()} == {"mart_seller_analytics"}
    assert {r.source_column for r in reconciliation.negative_amounts(broken).collect()} == {
        "mart_seller_analytics.total_revenue"
    }
    broken["int_orders_enriched"] = tables["int_orders_enriched"].withColumn("delivery_days", F.lit(-1))
    assert reconciliation.delivery_before_purchase(broken).count() == 4


def test_a_checked_build_counts_what_separate_checks_count(spark, tmp_path, monkeypatch):
    own_pass = {}
    plain = Warehouse.check_table

    def spied(self, name, report, skip=()):
        own_pass[name] = {c.name for c in catalogue.declared(name) if c.kind in checks.ROW_KINDS and c not in skip}
        return plain(self, name, report, skip)

    monkeypatch.setattr(Warehouse, "check_table", spied)
    house = Warehouse(spark, raw_tables(spark), folder=str(tmp_path))
    report = house.build_checked()
    key = lambda rows: sorted(tuple(r[c] for c in checks.RESULT_COLUMNS) for r in rows)
    apart = checks.run_checks(catalogue.declared(), house.tables()).collect()
    assert key(report.results) == key(apart) and len(apart) == 181
    # Only tables that no job writes are read for their row checks.
    assert {name for name, some in own_pass.items() if some} <= set(RAW_SCHEMAS) and not own_pass["int_orders_enriched"]
    kinds = {(c.table, c.name): c.kind for c in catalogue.declared()}
    for r in apart:
        if not r.passed and kinds[r.table_name, r.check_name] in checks.ROW_KINDS:
            stored = spark.read.parquet(report.failures[r.table_name, r.check_name])
            assert stored.count() == r.violations and set(stored.columns) == set(house.table(r.table_name).columns)


def test_a_row_that_fails_several_checks_is_stored_under_each(spark, tmp_path):
    df = spark.createDataFrame([(None, -1.0), (1, -2.0), (2, 3.0)], "k int, v double")
    some = [checks.not_null("t", "k"), checks.accepted_range("t", "v", 0)]
    paths = checks.store_row_failures(some, df, str(tmp_path))
    assert [spark.read.parquet(paths[c]).count() for c in some] == [1, 2]


def test_tags_prune_the_parts_of_a_table_without_failures(spark, tmp_path):
    some = [checks.not_null("t", "v"), checks.accepted_range("t", "v", 0, 99)]
    df = spark.sql("SELECT id, CAST(if(id = 7, NULL, if(id = 8, 500, id % 90)) AS INT) AS v FROM range(1000)")
    checks.with_tag(df, some).write.parquet(str(tmp_path / "t"))
    tagged = spark.read.parquet(str(tmp_path / "t"))
    found = checks.check_tags(tagged, some)
    assert [(r.check_name, r.violations, r.passed) for r in found.collect()] == [(c.name, 1, False) for c in some]
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert f"PushedFilters: [IsNotNull({checks.TAG}), GreaterThan({checks.TAG},0)]" in plan
    assert f"ReadSchema: struct<{checks.TAG}:bigint>" in plan


def test_models_are_scored_after_a_checked_build(spark, tmp_path):
    """Nothing that a checked build leaves in the session gets in the way of other jobs."""
    house = Warehouse(spark, raw_tables(spark), folder=str(tmp_path))
    house.build_checked()
    rows = spark.createDataFrame([(float(i % 5), float(i % 2)) for i in range(40)], "x double, label double")
    fitted = LogisticRegression(maxIter=2).fit(VectorAssembler(inputCols=["x"], outputCol="features").transform(rows))
    scored = fitted.transform(VectorAssembler(inputCols=["x"], outputCol="features").transform(rows))
    assert scored.repartition(2).select("probability").count() == 40 and len(scored.collect()) == 40
