"""Raw files, physical layout, catalog tables, shared folder."""

from __future__ import annotations

import shutil

import pytest
from fixtures import raw_tables
from pyspark.sql import functions as F

from tradewind.config import Settings
from tradewind.plans import registry
from tradewind.plans.warehouse import BuildStopped, Warehouse
from tradewind.session import cluster_settings, folder_bytes, shared_folder
from tradewind.sources import raw, sinks
from tradewind.sources.schemas import RAW_SCHEMAS


def test_csv_round_trip_gives_the_same_tables(spark, tmp_path):
    tables = raw_tables(spark)
    tables["order_reviews"] = tables["order_reviews"].withColumn(
        "review_comment_message", F.when(F.col("review_id") == "r_a", 'two\nlines, "quoted"').otherwise("plain")
    )
    for name, df in tables.items():
        df.coalesce(1).write.option("header", True).option("escape", '"').csv(str(tmp_path / f"{name}.csv"))
    # An empty field of a file is NULL.
    english = F.nullif("product_category_name_english", F.lit(""))
    names = "product_category_name_translation"
    tables[names] = tables[names].withColumn("product_category_name_english", english)
    loaded = raw.load_all_raw(spark, str(tmp_path))
    assert set(loaded) == set(RAW_SCHEMAS)
    for name, df in loaded.items():
        assert sorted(map(str, df.collect())) == sorted(map(str, tables[name].collect())), name
    house = Warehouse.from_files(spark, str(tmp_path), folder=str(tmp_path / "out"))
    assert house.table("int_orders_enriched").count() == 8


def _csv(tmp_path, name, *lines):
    (tmp_path / f"{name}.csv").write_text("\n".join(lines) + "\n")


def test_csv_columns_are_found_by_name(spark, tmp_path):
    _csv(
        tmp_path,
        "products",
        "product_photos_qty,name_length,product_id,product_category_name,product_width_cm,product_weight_g,"
        "product_height_cm,product_length_cm",
        "3,40,p1,toys,20,225,10,16",
        ",,p2,,,,,",
    )
    rows = {r.product_id: r for r in raw.load_raw(spark, str(tmp_path), "products").collect()}
    p = rows["p1"]
    assert (p.product_weight_g, p.product_length_cm, p.product_height_cm, p.product_width_cm) == (225, 16, 10, 20)
    assert p.product_photos_qty == 3 and p.product_category_name == "toys"
    assert rows["p2"].product_weight_g is None


def test_missing_columns_are_an_error(spark, tmp_path):
    _csv(tmp_path, "sellers", "seller_id,seller_city,seller_state", "s1,x,SP")
    with pytest.raises(ValueError, match="seller_zip_code_prefix"):
        raw.load_raw(spark, str(tmp_path), "sellers")
    spark.range(1).withColumnRenamed("id", "seller_id").write.parquet(str(tmp_path / "sellers.parquet"))
    with pytest.raises(ValueError, match="seller_city"):
        raw.load_raw(spark, str(tmp_path), "sellers", "parquet")


def test_files_with_another_header_are_an_error(spark, tmp_path):
    folder = tmp_path / "sellers.csv"
    folder.mkdir()
    (folder / "a.csv").write_text("seller_id,seller_zip_code_prefix,seller_city,seller_state\ns1,1,x,SP\n")
    (folder / "b.csv").write_text("seller_id,seller_city,seller_zip_code_prefix,seller_state\ns2,y,2,RJ\n")
    with pytest.raises(Exception, match="(?i)header"):
        raw.load_raw(spark, str(tmp_path), "sellers").collect()


def test_unparsable_values_are_an_error_or_set_aside(spark, tmp_path):
    _csv(
        tmp_path,
        "sellers",
        "seller_city,seller_id,seller_zip_code_prefix,seller_state",
        "x,s1,100,SP",
        "y,s2,1o0,RJ",
        "z,s3,,MG",
    )
    with pytest.raises(Exception, match="(?i)malformed|parse"):
        raw.load_raw(spark, str(tmp_path), "sellers").collect()
    good, rejected = raw.split_raw(spark, str(tmp_path), "sellers")
    assert sorted(r.seller_id for r in good.collect()) == ["s1", "s3"]
    assert [r[raw.REJECTED] for r in rejected.collect()] == ["y,s2,1o0,RJ"]


def test_checked_build_stores_failures_and_stops_dependants(spark, tmp_path):
    tables = raw_tables(spark)
    sellers = tables["sellers"]
    good = Warehouse(spark, tables, folder=str(tmp_path / "good"))
    report = good.build_checked()
    failing = {(r.table_name, r.check_name) for r in report.results if not r.passed}
    assert failing == set(report.failures) and failing and not report.stopped_by
    path = report.failures["order_items", "not_null_price"]
    assert [r.order_id for r in spark.read.parquet(path).collect()] == ["no_status"]
    tables["sellers"] = sellers.unionAll(sellers.limit(1))
    broken = Warehouse(spark, tables, folder=str(tmp_path / "broken"))
    with pytest.raises(BuildStopped) as stopped:
        broken.build_checked()
    left_out = stopped.value.report.stopped_by
    assert left_out["stg_sellers"] == left_out["mart_seller_analytics"] == "sellers"
    assert "stg_products" not in left_out and "mart_daily_order_anomalies" not in left_out
    assert stopped.value.report.failures["sellers", "unique_seller_id"]
    assert not (tmp_path / "broken" / "marts" / "mart_seller_analytics").exists()


def test_a_changed_table_is_read_again(spark, tmp_path):
    shutil.copytree("/root/testdata/sf0.001", tmp_path / "t")
    (tmp_path / "t").chmod(0o755)
    before = registry.warehouse(spark, str(tmp_path / "t"))
    assert registry.warehouse(spark, str(tmp_path / "t")) is before
    nation = tmp_path / "t" / "nation.parquet"
    (tmp_path / "t" / "more.parquet").write_bytes(nation.read_bytes())
    assert registry.warehouse(spark, str(tmp_path / "t")) is not before


def test_partitions_follow_the_input():
    assert int(cluster_settings(1 << 30)["spark.sql.shuffle.partitions"]) == 200
    assert int(cluster_settings(1 << 40)["spark.sql.shuffle.partitions"]) == 24_576
    largest = cluster_settings(100 << 40)  # bounded: the driver keeps a size per map task and partition
    assert int(largest["spark.sql.shuffle.partitions"]) == 50_000
    assert (100 << 40) / int(largest["spark.sql.files.maxPartitionBytes"]) <= 200_000
    assert cluster_settings(1 << 30)["spark.sql.files.maxPartitionBytes"] == str(128 << 20)


def test_too_few_partitions_for_the_input_are_a_warning(spark, tmp_path):
    tables = raw_tables(spark)
    with pytest.warns(UserWarning, match="cluster_settings"):
        Warehouse(spark, tables, folder=str(tmp_path), input_bytes=1 << 40)
    (tmp_path / "a").mkdir()
    (tmp_path / "a" / "x").write_bytes(b"12345")
    (tmp_path / "y").write_bytes(b"123")
    assert folder_bytes(spark, str(tmp_path)) == 8


def test_raw_tables_are_scanned_without_an_exchange(spark):
    for name in ("orders", "order_items", "order_payments"):
        df = Warehouse.from_tpch(spark, "/root/testdata/sf0.001").table(name)
        assert "Exchange" not in df._jdf.queryExecution().executedPlan().toString()


def test_parquet_source(spark, tmp_path):
    raw_tables(spark)["sellers"].write.parquet(str(tmp_path / "sellers.parquet"))
    assert raw.load_raw(spark, str(tmp_path), "sellers", "parquet").count() == 3


def test_window_reaches_the_scan(spark, tmp_path):
    raw_tables(spark)["orders"].write.parquet(str(tmp_path / "orders.parquet"))
    orders = raw.load_raw(spark, str(tmp_path), "orders", "parquet")
    kept = raw.purchase_window(orders, Settings(start_date="2018-01-02", end_date="2018-01-07"))
    plan = kept._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(order_purchase_timestamp" in plan
    assert {r.order_id for r in kept.collect()} == {"early", "canceled"}


def test_window_of_the_adapter_prunes_the_scan(spark):
    folder = "/root/testdata/sf0.001"
    window = Settings(start_date="1996-01-01", end_date="1997-01-01")
    orders = Warehouse.from_tpch(spark, folder, settings=window).table("stg_orders")
    plan = orders._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(o_orderdate,1995-12-31" in plan
    placed = F.col("order_purchase_timestamp")
    everything = Warehouse.from_tpch(spark, folder).table("stg_orders")
    wanted = everything.where((placed >= "1996-01-01") & (placed < "1997-01-01"))
    assert orders.count() == wanted.count() > 0


def test_month_layout_is_sorted_and_pruned(spark, tmp_path):
    df = spark.sql(
        "SELECT date_add(DATE '2018-01-20', CAST(id % 40 AS INT)) AS day, id FROM range(200)"
    ).repartition(5)
    path = sinks.write_table(df, str(tmp_path), "marts", "m", sort_by=("day", "id"), month_of="day")
    back = spark.read.parquet(path)
    assert sorted(p.name for p in (tmp_path / "marts" / "m").glob("purchase_ym=*")) == [
        "purchase_ym=201801",
        "purchase_ym=201802",
    ]
    plan = back.where("purchase_ym = 201801")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(purchase_ym" in plan
    rows = back.where("purchase_ym = 201801").collect()
    assert [(r.day, r.id) for r in rows] == sorted((r.day, r.id) for r in rows)
    assert back.count() == 200


def test_null_sort_keys_are_allowed(spark, tmp_path):
    df = spark.sql("SELECT nullif(id, 3) AS k FROM range(5)").coalesce(1)
    back = spark.read.parquet(sinks.write_table(df, str(tmp_path), "marts", "n", sort_by=("k",)))
    assert [r.k for r in back.collect()] == [0, 1, 2, 4, None]


def test_overwrite_replaces(spark, tmp_path):
    for n in (5, 2):
        path = sinks.write_table(spark.range(n), str(tmp_path), "marts", "r")
    assert spark.read.parquet(path).count() == 2


def test_comments_are_stored(spark, tmp_path):
    path = sinks.write_table(spark.range(1), str(tmp_path), "marts", "c", comments={"id": "the key"})
    assert spark.read.parquet(path).schema["id"].metadata["comment"] == "the key"


@pytest.fixture
def catalog(spark):
    names = ["tw_marts.orders", "tw_marts.items"]
    yield names
    for name in names:
        spark.sql(f"DROP TABLE IF EXISTS {name}")
    spark.sql("DROP DATABASE IF EXISTS tw_marts")


def test_bucketed_catalog_tables_join_without_a_shuffle(spark, catalog, monkeypatch):
    df = spark.range(100).withColumnRenamed("id", "order_id")
    for name in ("orders", "items"):
        sinks.save_table(
            spark, df, "tw_marts", name, sort_by=("order_id",), bucket_by=(4, "order_id"),
            comment="a seller's orders", comments={"order_id": "key"},
        )
    assert spark.catalog.listColumns("tw_marts.orders")[0].description == "key"
    assert spark.catalog.getTable("tw_marts.orders").description == "a seller's orders"
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = spark.table("tw_marts.orders").join(spark.table("tw_marts.items"), "order_id")
        assert "Exchange" not in joined._jdf.queryExecution().executedPlan().toString()
        assert joined.count() == 100
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)


def test_shared_folder_is_the_configured_one(spark):
    assert shared_folder(spark) == spark.conf.get("spark.checkpoint.dir", shared_folder(spark)).rstrip("/")


def test_cluster_without_shared_folder_is_an_error():
    class Cluster:
        class conf:
            @staticmethod
            def get(key, default=None):
                return default

        class sparkContext:
            master = "yarn"

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        shared_folder(Cluster)


# --- versions, months, accounting ------------------------------------------------------------------


def test_readers_get_the_old_version_until_the_new_one_is_whole(spark, tmp_path):
    place = (str(tmp_path), "marts", "m")
    with pytest.raises(FileNotFoundError):
        sinks.published_table(spark, *place)
    sinks.publish_table(spark, spark.range(5), *place)
    early = sinks.published_table(spark, *place)
    # A job that dies after some of its tasks have written.
    broken = spark.range(0, 4000, 1, 8).select(F.when(F.col("id") < 3500, F.col("id")).otherwise(F.raise_error(F.lit("lost"))).alias("id"))
    with pytest.raises(Exception, match="lost"):
        sinks.publish_table(spark, broken, *place)
    assert len(list((tmp_path / "marts" / "m").glob("v-*"))) == 2  # the dead one is there, and nobody reads it
    assert sinks.published_table(spark, *place).count() == 5
    sinks.publish_table(spark, sinks.published_table(spark, *place).where("id > 2"), *place)  # made of itself
    assert sorted(r.id for r in sinks.published_table(spark, *place).collect()) == [3, 4]
    assert early.count() == 5  # who began before still reads what they began with


def test_old_versions_and_dead_ones_are_removed(spark, tmp_path):
    place = (str(tmp_path), "marts", "m")
    for n in range(1, 6):
        (tmp_path / "marts" / "m").mkdir(parents=True, exist_ok=True)
        sinks.publish_table(spark, spark.range(n), *place, sort_by=("id",))
        (tmp_path / "marts" / "m" / f"v-{n:010d}-dead").mkdir()
        assert sinks.published_table(spark, *place).count() == n
    numbers = {int(p.name.split("-")[1]) for p in (tmp_path / "marts" / "m").glob("v-*")}
    assert numbers == {4, 5} and (tmp_path / "marts" / "m" / sinks.MANIFEST).exists()


def test_a_window_reads_its_months_only(spark, tmp_path):
    orders = raw_tables(spark)["orders"]
    path = raw.store_orders(orders, str(tmp_path))
    window = Settings(start_date="2018-01-02", end_date="2018-01-07")
    got = raw.stored_orders(spark, path, window)
    assert sorted(r.order_id for r in got.collect()) == sorted(r.order_id for r in raw.purchase_window(orders, window).collect())
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(purchase_ym" in plan and "201801" in plan
    assert raw.stored_orders(spark, path).count() == orders.count()
    assert set(raw.stored_orders(spark, path).columns) == set(orders.columns)


@pytest.mark.parametrize(
    "start, end, months",
    [("2018-01-15", "2018-03-01", {201801, 201802}), ("2018-01-31 23:00:00", "2018-02-01 00:00:01", {201801, 201802}), ("2017-12-01", "2018-01-01", {201712})],
)
def test_months_of_a_window(spark, start, end, months):
    df = spark.createDataFrame([(m,) for m in (201711, 201712, 201801, 201802, 201803, None)], "purchase_ym int")
    assert {r.purchase_ym for r in df.where(sinks.months_between(start, end)).collect()} == months


def test_a_backfill_leaves_other_months_alone(spark, tmp_path):
    days = "SELECT CAST(date_add(DATE '2018-01-20', CAST(id % 60 AS INT)) AS TIMESTAMP_NTZ) AS order_purchase_timestamp, id FROM range(180)"
    path = raw.store_orders(spark.sql(days), str(tmp_path))
    before = {p.name: p.stat().st_mtime_ns for p in (tmp_path / "raw" / "orders" / "purchase_ym=201803").glob("*.parquet")}
    new = spark.sql("SELECT TIMESTAMP_NTZ'2018-02-05 10:00:00' AS order_purchase_timestamp, id FROM range(7)")
    sinks.replace_months(new, path, month_of="order_purchase_timestamp")
    counts = {r.purchase_ym: r["count"] for r in spark.read.parquet(path).groupBy("purchase_ym").count().collect()}
    assert counts == {201801: 36, 201802: 7, 201803: 60}
    after = {p.name: p.stat().st_mtime_ns for p in (tmp_path / "raw" / "orders" / "purchase_ym=201803").glob("*.parquet")}
    assert before == after


def test_every_value_of_a_file_is_accounted_for(spark, tmp_path):
    folder = tmp_path / "sellers.csv"
    folder.mkdir()
    header = "seller_city,seller_id,seller_zip_code_prefix,seller_state\n"
    (folder / "a.csv").write_text(header + "x,s1,100,SP\ny,s2,10oo,RJ\n")
    (folder / "b.csv").write_text(header + "z,s3,,MG\n")
    # The error is in a column that this query does not read, so it passes unseen ...
    assert raw.load_raw(spark, str(tmp_path), "sellers").select("seller_state").count() == 3
    done = raw.ingest_raw(spark, str(tmp_path), "sellers", str(tmp_path / "out"))
    # ... but not through the account of the file.
    assert (done.accepted_rows, done.rejected_rows) == (2, 1)
    assert sorted(r.seller_id for r in done.accepted.select("seller_id").collect()) == ["s1", "s3"]
    assert [r[raw.REJECTED] for r in done.rejected.collect()] == ["y,s2,10oo,RJ"]
    per_file = {r.source_file.rsplit("/", 1)[1]: (r.accepted, r.rejected) for r in done.per_file.collect()}
    assert per_file == {"a.csv": (1, 1), "b.csv": (1, 0)}
    assert (tmp_path / "out" / "sellers_accounting" / "_SUCCESS").exists()


def test_an_empty_file_is_accounted_for(spark, tmp_path):
    (tmp_path / "sellers.csv").write_text("seller_id,seller_city,seller_zip_code_prefix,seller_state\n")
    done = raw.ingest_raw(spark, str(tmp_path), "sellers", str(tmp_path / "out"))
    assert (done.accepted_rows, done.rejected_rows, done.accepted.count(), done.rejected.count()) == (0, 0, 0, 0)
