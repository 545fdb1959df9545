"""Registered queries: every table, operator, check and training job over one folder of tables."""

from __future__ import annotations

from collections.abc import Callable, Iterable
from datetime import datetime
from functools import partial, reduce

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tradewind.config import AnomalySettings, Settings, TrainingSettings
from tradewind.functions import expressions as x
from tradewind.functions.ranking import grouped_percentiles
from tradewind.ml import checks as ml_checks
from tradewind.ml import dataset, metrics, model
from tradewind.operators import intermediate, marts, staging
from tradewind.plans.contracts import conform
from tradewind.plans.warehouse import CHECKED, DATASETS, BuildReport, Warehouse, layer_of
from tradewind.quality import catalogue, checks, reconciliation
from tradewind.sources import raw, sinks

# Parameters of the registered queries.
WINDOW = Settings(start_date="1996-01-01", end_date="1997-01-01")
SHORT_WINDOW = AnomalySettings(rolling_window_days=3, anomaly_z_threshold=2)
CLOCK = datetime(2011, 7, 31, 11)  # half a day beyond the first limit
FINGERPRINT_PARAMS = {"test_frac": 0.2, "seed": 42}
RECONCILED = ("int_orders_enriched", "stg_order_items", *reconciliation.RATES)

_WAREHOUSES: dict[tuple, tuple[str, Warehouse]] = {}


def warehouse(spark: SparkSession, folder: str) -> Warehouse:
    """The tables of a folder, shared by the queries of one Spark application while its files stay the same."""
    key, state = (spark.sparkContext.applicationId, folder), _folder_state(spark, folder)
    if key not in _WAREHOUSES or _WAREHOUSES[key][0] != state:
        _WAREHOUSES[key] = (state, Warehouse.from_tpch(spark, folder))
    return _WAREHOUSES[key][1]


def _folder_state(spark: SparkSession, folder: str) -> str:
    """Names and times of the tables of a folder, and the number and size of all files below it.

    The file system adds the files up by itself; only one entry per table comes to the driver.
    """
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    files = path.getFileSystem(spark._jsc.hadoopConfiguration())
    entries = sorted(f"{e.getPath().getName()} {e.getModificationTime()}" for e in files.listStatus(path))
    total = files.getContentSummary(path)
    return "\n".join([*entries, f"{total.getFileCount()} {total.getLength()}"])


def _rows(name: str = "rows_cnt"):
    return F.count(F.lit(1)).alias(name)


# --- sources and sinks ---------------------------------------------------------------------------


def stg_orders_window(w: Warehouse) -> DataFrame:
    return Warehouse.from_tpch(w.spark, w.memo["source"], settings=WINDOW, folder=w.folder).table("stg_orders")


def raw_products_reloaded(w: Warehouse) -> DataFrame:
    """Products written as CSV with columns in another order and one more, then loaded by name."""
    products = w.table("products")
    shuffled = products.select(F.lit("x").alias("note"), *reversed(products.columns))
    folder = f"{w.folder}/files"
    shuffled.write.mode("overwrite").option("header", True).option("escape", '"').csv(f"{folder}/products.csv")
    return raw.load_raw(w.spark, folder, "products")


def sink_monthly_partitions(w: Warehouse) -> DataFrame:
    path = sinks.write_table(
        w.table("mart_daily_state_metrics"),
        w.folder,
        "marts",
        "daily_state_metrics_by_month",
        sort_by=("order_purchase_date", "customer_state"),
        month_of="order_purchase_date",
        comments={"order_purchase_date": "day of purchase"},
    )
    return (
        w.spark.read.parquet(path)
        .groupBy(F.col(sinks.MONTH).cast("string").alias(sinks.MONTH))
        .agg(_rows(), F.sum("orders_cnt").alias("orders_cnt"), F.sum("total_revenue").alias("total_revenue"))
    )


def stg_orders_month_window(w: Warehouse) -> DataFrame:
    """The window over raw orders stored by month: only its months are read."""
    path = raw.store_orders(w.table("orders"), f"{w.folder}/window")
    return staging.stg_orders(raw.stored_orders(w.spark, path, WINDOW))


def sink_backfilled_months(w: Warehouse) -> DataFrame:
    """Raw orders by month, of which one year is replaced by its delivered orders."""
    orders = w.table("orders")
    path = raw.store_orders(orders, f"{w.folder}/backfill")
    year = raw.purchase_window(orders, WINDOW).where("order_status = 'delivered'")
    sinks.replace_months(year, path, month_of="order_purchase_timestamp")
    delivered = x.count_if(F.col("order_status") == "delivered").alias("delivered_cnt")
    return w.spark.read.parquet(path).groupBy(F.col(sinks.MONTH).cast("string").alias(sinks.MONTH)).agg(_rows(), delivered)


def sink_published_sellers(w: Warehouse) -> DataFrame:
    """Two published versions of a table, the second made from the first; readers get the second."""
    place = (w.folder, "published", "sellers")
    sinks.publish_table(w.spark, w.table("stg_sellers"), *place)
    half = sinks.published_table(w.spark, *place).where("seller_id % 2 = 0")
    sinks.publish_table(w.spark, half, *place)
    return sinks.published_table(w.spark, *place).groupBy("seller_state").agg(_rows("sellers_cnt"))


def raw_accounting(w: Warehouse) -> DataFrame:
    """Products as CSV in which some weights are no numbers: counts of both sorts, and what was set aside."""
    weight = F.when(F.col("product_id") % 97 == 0, "heavy").otherwise(F.col("product_weight_g").cast("string"))
    folder = f"{w.folder}/accounting"
    products = w.table("products").withColumn("product_weight_g", weight)
    products.write.mode("overwrite").option("header", True).option("escape", '"').csv(f"{folder}/products.csv")
    done = raw.ingest_raw(w.spark, folder, "products", f"{folder}/stored")
    length = F.sum("product_length_cm")
    return done.per_file.agg(F.sum("accepted").alias("accepted"), F.sum("rejected").alias("rejected")).crossJoin(
        done.accepted.agg(length.alias("accepted_length"))
    ).crossJoin(done.rejected.agg(length.alias("rejected_length")))


def sink_train_holdout(w: Warehouse) -> DataFrame:
    train, holdout = dataset.training_dataset(w.table("mart_order_features"))
    paths = dataset.write_training_dataset(train, holdout, w.folder)
    parts = [
        w.spark.read.parquet(path).agg(_rows(), F.sum(dataset.TARGET).alias("late_cnt")).withColumn(
            "part", F.lit(name)
        )
        for name, path in paths.items()
    ]
    return parts[0].unionByName(parts[1])


# --- single operators ----------------------------------------------------------------------------


def seller_price_percentiles(w: Warehouse) -> DataFrame:
    items = w.table("int_order_items_enriched")
    wanted = {"p05_price": 0.05, "median_price": 0.5, "p95_price": 0.95}
    return grouped_percentiles(items, ["seller_id"], "price", wanted)


def state_categories(w: Warehouse) -> DataFrame:
    name = x.string_agg_distinct("product_category_name_english").alias("categories")
    return w.table("int_order_items_enriched").groupBy("customer_state").agg(name)


def class_balance(w: Warehouse) -> DataFrame:
    target = F.col(dataset.TARGET)
    return w.table("mart_order_features").agg(
        F.round(F.avg(target), 4).alias("positive_rate"),
        F.count(target).alias("known_cnt"),
        x.count_if(target.isNull()).alias("unknown_cnt"),
    )


def price_segments(w: Warehouse) -> DataFrame:
    return w.table("stg_order_items").groupBy("price_segment").agg(
        _rows("items_cnt"), x.safe_div(F.sum("freight_value"), F.sum("item_total")).alias("freight_share")
    )


def order_calendar(w: Warehouse) -> DataFrame:
    placed = F.col("order_purchase_timestamp")
    return (
        w.table("stg_orders")
        .groupBy(
            x.dow_of(placed).alias("order_dow"),
            x.weekday_name(x.dow_of(placed)).alias("dow_name"),
            x.month_of(placed).alias("purchase_month"),
            x.hour_of(placed).alias("order_hour"),
        )
        .agg(_rows("orders_cnt"), F.avg("delivery_delay_days").alias("avg_delay_days"))
    )


def seller_state_distance(w: Warehouse) -> DataFrame:
    """Distance over items, by seller state and customer state."""
    distance = F.col("customer_seller_distance_km")
    return (
        w.table("int_order_items_enriched")
        .groupBy("seller_state", "customer_state")
        .agg(F.min(distance).alias("nearest_km"), F.avg(distance).alias("mean_km"))
    )


# --- checks --------------------------------------------------------------------------------------


def dq_table(table: str, w: Warehouse) -> DataFrame:
    declared = catalogue.declared(table)
    names = {table, *(c.parent for c in declared if c.parent)}
    return checks.check_table(declared, {name: w.table(name) for name in names})


def dq_rates(w: Warehouse) -> DataFrame:
    value = F.col("metric_value")
    return (
        reconciliation.all_rates(w_tables(w, reconciliation.RATES))
        .groupBy("model_name", "metric_name")
        .agg(
            _rows("rates_cnt"),
            x.count_if(value.isNull()).alias("undefined_cnt"),
            x.count_if((value < 0) | (value > 100)).alias("out_of_bounds_cnt"),
            F.max(value).alias("max_rate"),
        )
    )


def w_tables(w: Warehouse, names: Iterable[str] = RECONCILED) -> dict[str, DataFrame]:
    """Only the tables that a check reads: asking for a table builds it."""
    return {name: w.table(name) for name in sorted({*names})}


def dq_negative_amounts(w: Warehouse) -> DataFrame:
    """Violations per money column, with the columns that have none."""
    found = (
        reconciliation.negative_amounts(w_tables(w, [table for table, _ in reconciliation.MONEY]))
        .groupBy("source_column")
        .agg(F.count(F.lit(1)).alias("bad_cnt"))
    )
    names = ", ".join(f"'{table}.{column}'" for table, column in reconciliation.MONEY)
    all_columns = w.spark.sql(f"SELECT explode(array({names})) AS source_column")
    return all_columns.join(found, "source_column", "left").fillna(0, ["bad_cnt"])


def dq_freshness(w: Warehouse) -> DataFrame:
    return checks.freshness(w.table("orders"), now=CLOCK, **catalogue.FRESHNESS)


def dq_stored_failures(w: Warehouse) -> DataFrame:
    check = checks.accepted_values("int_orders_enriched", "customer_region", ("ASIA", "EUROPE"))
    path = checks.store_failures(check, w_tables(w, [check.table]), w.folder)
    return w.spark.read.parquet(path).groupBy("customer_region").agg(_rows("failing_cnt"))


def dq_failed_checks(w: Warehouse) -> DataFrame:
    """Stored failing rows of every declared check that fails, counted per check.

    Raw and staging tables are checked in one query, the tables built on them in another.
    """
    report = BuildReport()
    early = [table for table in CHECKED if layer_of(table) in ("seeds", "staging")]
    w.check_together(early, report)
    w.check_together([table for table in CHECKED if table not in early], report)
    counted = [
        w.spark.read.parquet(path)
        .agg(_rows("failing_cnt"))
        .select(F.lit(table).alias("table_name"), F.lit(name).alias("check_name"), "failing_cnt")
        for (table, name), path in report.failures.items()
    ]
    none = w.spark.sql("SELECT '' AS table_name, '' AS check_name, 0L AS failing_cnt WHERE false")
    return reduce(DataFrame.unionByName, counted, none)


def dq_duplicate_lines(w: Warehouse) -> DataFrame:
    """Failing groups of a unique-combination check that the data does break."""
    payments = w.table("order_payments").withColumnRenamed("payment_installments", "line_number")
    check = checks.unique_combination("order_payments", ("order_id", "line_number"))
    return checks.failing_rows(check, {"order_payments": payments})


# --- training ------------------------------------------------------------------------------------


def ml_split(w: Warehouse) -> DataFrame:
    settings = TrainingSettings()
    held = dataset.in_holdout(settings.test_frac, settings.seed)
    return w.table("mart_order_features").select(
        "order_id",
        x.hash_bucket("order_id", settings.seed).alias("bucket"),
        F.when(held, "holdout").otherwise("train").alias("part"),
    )


def _train(w: Warehouse) -> DataFrame:
    return dataset.training_dataset(w.table("mart_order_features"))[0]


def ml_no_leakage(w: Warehouse) -> DataFrame:
    """Features at six digits: noise in the last digit of a float sum must not decide about ties."""
    rounded = _train(w).withColumns({c: F.round(c, 6) for c in dataset.NUMERIC})
    return ml_checks.no_leakage(rounded)


def ml_scaling(w: Warehouse) -> DataFrame:
    train = _train(w)
    row = model.scaling(train, model.fill_values(train))
    each = [
        F.struct(
            F.lit(c).alias("feature"), F.col(f"{c}_mean").alias("mean"), F.col(f"{c}_std").alias("std")
        )
        for c in dataset.NUMERIC
    ]
    return row.select(F.inline(F.array(*each)))


def hashed_scores(w: Warehouse) -> DataFrame:
    """Labelled orders with a score that any engine computes alike, with many ties."""
    return dataset.labelled(w.table("mart_order_features")).select(
        dataset.TARGET, "customer_state", ((F.col("order_id") * 37 % 1000) / F.lit(1000.0)).alias("score")
    )


def ml_metrics_with_unlabelled(w: Warehouse) -> DataFrame:
    """The same scores over all orders: those without an outcome must not count."""
    scored = w.table("mart_order_features").select(
        dataset.TARGET, ((F.col("order_id") * 37 % 1000) / F.lit(1000.0)).alias("score")
    )
    return metrics.evaluate(scored, dataset.TARGET, "score")


def _evaluate(w: Warehouse, keys: tuple[str, ...] = ()) -> DataFrame:
    return metrics.evaluate(hashed_scores(w), dataset.TARGET, "score", keys=keys)


def _fitted(w: Warehouse) -> tuple[PipelineModel, DataFrame, DataFrame]:
    """(model, train, holdout), fitted once per warehouse on the written training rows."""
    if "fitted" not in w.memo:
        paths = dataset.write_training_dataset(
            *dataset.training_dataset(w.table("mart_order_features")), f"{w.folder}/fit"
        )
        train, holdout = (w.spark.read.parquet(paths[part]) for part in ("train", "holdout"))
        w.memo["fitted"] = (model.fit(train), train, holdout)
    return w.memo["fitted"]


def _holdout_metrics(w: Warehouse) -> DataFrame:
    fitted, _, holdout = _fitted(w)
    return metrics.evaluate(model.score(fitted, holdout), dataset.TARGET, "score")


def ml_metrics(w: Warehouse) -> DataFrame:
    """Metrics of the fitted model on the holdout rows: the exact ones, and whether it passes the gate."""
    good = F.col("roc_auc").between(ml_checks.MIN_ROC_AUC, 1) & F.col("pr_auc").between(0, 1)
    return _holdout_metrics(w).select("n_rows", "positive_rate", good.alias("passed"))


def ml_scores(w: Warehouse) -> DataFrame:
    fitted, _, holdout = _fitted(w)
    return model.score(fitted, holdout).select(
        "order_id", dataset.TARGET, F.col("score").between(0, 1).alias("in_bounds")
    )


def ml_optimality(w: Warehouse) -> DataFrame:
    """Gradient of the fitted objective per coefficient over the training rows, at three digits: all zero."""
    fitted, train, _ = _fitted(w)
    gradient = model.gradient(fitted, train)
    return gradient.select("coefficient", (F.round("gradient", 3) + F.lit(0.0)).alias("gradient"))


def ml_quality_gate(w: Warehouse) -> DataFrame:
    return ml_checks.quality_gate(_holdout_metrics(w)).drop("roc_auc_holdout")


OPERATORS: dict[str, Callable[[Warehouse], DataFrame]] = {
    "raw_state_region": lambda w: w.table("seed_state_region"),
    "raw_products_reloaded": raw_products_reloaded,
    "raw_order_payments": lambda w: w.table("order_payments"),
    "stg_orders_window": stg_orders_window,
    "stg_orders_month_window": stg_orders_month_window,
    "raw_accounting": raw_accounting,
    "sink_monthly_partitions": sink_monthly_partitions,
    "sink_backfilled_months": sink_backfilled_months,
    "sink_published_sellers": sink_published_sellers,
    "sink_train_holdout": sink_train_holdout,
    "order_totals": lambda w: intermediate.order_totals(w.table("stg_order_items"), w.heavy_orders()),
    "order_product_dims": lambda w: marts.order_product_dims(
        w.table("stg_order_items"), w.table("stg_products"), w.heavy_orders()
    ),
    "daily_orders": lambda w: marts.daily_orders(w.table("stg_orders")),
    "seller_price_percentiles": seller_price_percentiles,
    "state_categories": state_categories,
    "class_balance": class_balance,
    "price_segments": price_segments,
    "order_calendar": order_calendar,
    "seller_state_distance": seller_state_distance,
    "anomalies_short_window": lambda w: marts.mart_daily_order_anomalies(w.table("stg_orders"), SHORT_WINDOW),
    "anomalies_by_state": lambda w: marts.mart_daily_order_anomalies(
        w.table("int_orders_enriched"), w.anomalies, ("customer_state",)
    ),
    "anomalies_by_status_shared_calendar": lambda w: marts.mart_daily_order_anomalies(
        w.table("int_orders_enriched"), SHORT_WINDOW, ("customer_region", "order_status"), shared_calendar=True
    ),
    "daily_orders_by_region": lambda w: marts.daily_orders(w.table("int_orders_enriched"), ("customer_region",)),
    "dq_reconciliation": lambda w: reconciliation.run(w_tables(w)),
    "dq_revenue_totals": lambda w: reconciliation.revenue_totals(
        w_tables(w, ("mart_daily_state_metrics", "stg_order_items"))
    ),
    "dq_rates": dq_rates,
    "dq_negative_amounts": dq_negative_amounts,
    "dq_freshness": dq_freshness,
    "dq_stored_failures": dq_stored_failures,
    "dq_failed_checks": dq_failed_checks,
    "dq_duplicate_lines": dq_duplicate_lines,
    "ml_features": lambda w: dataset.feature_frame(w.table("mart_order_features")),
    "ml_split": ml_split,
    "ml_training_metadata": lambda w: dataset.training_metadata(w.table("mart_order_features")),
    "ml_medians": lambda w: model.medians(_train(w)),
    "ml_scaling": ml_scaling,
    "ml_roc_auc": _evaluate,
    "ml_average_precision": _evaluate,
    "ml_accuracy": _evaluate,
    "ml_metrics_by_state": lambda w: _evaluate(w, ("customer_state",)),
    "ml_no_leakage": ml_no_leakage,
    "ml_quality_gate": ml_quality_gate,
    "ml_metrics": ml_metrics,
    "ml_scores": ml_scores,
    "ml_optimality": ml_optimality,
    "ml_metrics_with_unlabelled": ml_metrics_with_unlabelled,
    "ml_fingerprint": lambda w: dataset.dataset_fingerprint(_train(w), FINGERPRINT_PARAMS),
}
def _run(build: Callable[[Warehouse], DataFrame], name: str, spark: SparkSession, folder: str) -> DataFrame:
    return conform(name, build(warehouse(spark, folder)))


def _table(name: str, w: Warehouse) -> DataFrame:
    return w.table(name)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    builders: dict[str, Callable[[Warehouse], DataFrame]] = {
        name: partial(_table, name) for name in DATASETS
    }
    builders |= OPERATORS
    builders |= {f"dq_{table}": partial(dq_table, table) for table in catalogue.CONTRACT}
    return {name: partial(_run, build, name) for name, build in builders.items()}
