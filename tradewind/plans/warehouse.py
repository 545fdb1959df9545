"""The tables of one run over one set of raw tables.

A table is a DataFrame built on first use. The tables that several others read are written once to
the shared folder and read back: dimensions, so that the planner knows their file size when it
decides about a broadcast, what items say about their orders, so that item rows are exchanged once for
totals and distances, the two wide tables, so that seven marts do not repeat their joins, and the marts
that checks read.
"""

from __future__ import annotations

import uuid
import warnings
from collections.abc import Callable, Sequence
from concurrent.futures import Future, ThreadPoolExecutor
from dataclasses import dataclass, field, fields
from functools import reduce
from threading import Lock, RLock

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession

from tradewind.config import AnomalySettings, Settings
from tradewind.functions import skew
from tradewind.operators import intermediate, marts, partials, staging
from tradewind.quality import catalogue, checks
from tradewind.session import PARTITION_BYTES, folder_bytes, shared_folder
from tradewind.sources import raw as raw_source
from tradewind.sources import sinks, tpch
from tradewind.sources.schemas import RAW_SCHEMAS

ANOMALIES = AnomalySettings(rolling_window_days=7, anomaly_z_threshold=3)

STAGING = (
    "stg_customers",
    "stg_geolocation",
    "stg_order_items",
    "stg_order_payments",
    "stg_order_reviews",
    "stg_orders",
    "stg_products",
    "stg_sellers",
)
INTERMEDIATE = ("int_order_distance", "int_orders_enriched", "int_order_items_enriched")
# Sort key and month column of each mart, as the published project lays them out.
MARTS = {
    "mart_daily_state_metrics": (("order_purchase_date", "customer_state"), "order_purchase_date"),
    "mart_delivery_quality_by_category": (("product_category_name_english",), None),
    "mart_delivery_quality_by_state": (("customer_state",), None),
    "mart_hourly_order_pattern": (("order_dow", "order_hour"), None),
    "mart_customer_value_profile": (("customer_unique_id",), None),
    "mart_seller_analytics": (("seller_id",), None),
    "mart_order_features": (("order_id",), None),
    "mart_daily_order_anomalies": ((), None),
}
DATASETS = (*STAGING, *INTERMEDIATE, *MARTS)

# Written once and read back, for the reasons given above.
SHARED = frozenset(
    {
        "seed_state_region",
        "stg_geolocation",
        "stg_products",
        "stg_sellers",
        "int_seller_points",
        "int_order_facts",
        "int_orders_enriched",
        "int_order_items_enriched",
        *MARTS,
    }
) - {"mart_customer_value_profile", "mart_daily_order_anomalies"}
# Written besides these where all tables are checked, since more than one step reads them then.
REREAD = frozenset(
    {
        "stg_customers",
        "stg_order_payments",
        "stg_order_reviews",
        "mart_customer_value_profile",
        "mart_daily_order_anomalies",
    }
)
# What each table reads, for stopping what depends on a table with a blocking failure.
DEPENDS = {
    "stg_customers": ("customers",),
    "stg_geolocation": ("geolocation",),
    "stg_order_items": ("order_items",),
    "stg_order_payments": ("order_payments",),
    "stg_order_reviews": ("order_reviews",),
    "stg_orders": ("orders",),
    "stg_products": ("products", "product_category_name_translation"),
    "stg_sellers": ("sellers",),
    "int_order_distance": ("stg_order_items", "stg_orders", "stg_customers", "stg_sellers", "stg_geolocation"),
    "int_orders_enriched": (
        "stg_orders",
        "stg_customers",
        "stg_order_items",
        "stg_order_payments",
        "stg_order_reviews",
        "int_order_distance",  # both are made of the facts of an order's items
        "seed_state_region",
    ),
    "int_order_items_enriched": (
        "stg_order_items",
        "int_orders_enriched",
        "stg_products",
        "stg_sellers",
        "seed_state_region",
    ),
    "mart_daily_state_metrics": ("int_orders_enriched",),
    "mart_delivery_quality_by_category": ("int_order_items_enriched",),
    "mart_delivery_quality_by_state": ("int_orders_enriched",),
    "mart_hourly_order_pattern": ("int_orders_enriched",),
    "mart_customer_value_profile": ("int_orders_enriched",),
    "mart_seller_analytics": ("int_order_items_enriched",),
    "mart_order_features": ("int_orders_enriched", "stg_order_items", "stg_products"),
    "mart_daily_order_anomalies": ("stg_orders",),
}
CHECKED = tuple(catalogue.CONTRACT)
AT_ONCE = 4  # tables written side by side, so that the last tasks of one leave no cores idle


@dataclass
class BuildReport:
    """Results of a checked build: one entry per check, paths of stored failures, what was left out."""

    results: list = field(default_factory=list)
    failures: dict[tuple[str, str], str] = field(default_factory=dict)
    stopped_by: dict[str, str] = field(default_factory=dict)  # table left out -> the table at fault


class BuildStopped(RuntimeError):
    def __init__(self, report: BuildReport) -> None:
        super().__init__(f"not built: {report.stopped_by}")
        self.report = report


def layer_of(name: str) -> str:
    for prefix, layer in (("stg_", "staging"), ("int_", "intermediate"), ("mart_", "marts")):
        if name.startswith(prefix):
            return layer
    return "seeds"


class Warehouse:
    def __init__(
        self,
        spark: SparkSession,
        raw: dict[str, DataFrame],
        settings: Settings = Settings(),
        anomalies: AnomalySettings = ANOMALIES,
        folder: str | None = None,
        input_bytes: int = 0,
    ) -> None:
        """``input_bytes``: size of the raw files, if known, to hold the session's partitions against."""
        self.spark = spark
        self.raw = raw
        _warn_about_partitions(spark, input_bytes)
        self.settings = settings
        self.anomalies = anomalies
        self.folder = folder or f"{shared_folder(spark)}/tradewind-{uuid.uuid4().hex}"
        self.memo: dict = {}  # what queries over these tables share, such as a fitted model
        self._tables: dict[str, DataFrame] = {}
        self._reread: set[str] = set()  # tables of REREAD that are written
        self._guard, self._locks = Lock(), {}

    @classmethod
    def from_files(cls, spark: SparkSession, source: str, fmt: str = "csv", **options) -> Warehouse:
        options.setdefault("input_bytes", folder_bytes(spark, source))
        return cls(spark, raw_source.load_all_raw(spark, source, fmt), **options)

    @classmethod
    def from_tpch(cls, spark: SparkSession, source: str, **options) -> Warehouse:
        settings = options.get("settings", Settings())
        options.setdefault("input_bytes", folder_bytes(spark, source))
        house = cls(spark, tpch.raw_tables(spark, source, settings), **options)
        house.memo["source"] = source
        return house

    def _making(self, what) -> RLock:
        """Lock of a table or result that must be made once, also where several are made side by side."""
        with self._guard:
            return self._locks.setdefault(what, RLock())

    def table(self, name: str) -> DataFrame:
        with self._making(name):
            if name not in self._tables:
                df = self.raw[name] if name in RAW_SCHEMAS else self.define(name)
                self._tables[name] = self.write(name, df) if name in SHARED else df
            return self._tables[name]

    def tables(self) -> dict[str, DataFrame]:
        return {name: self.table(name) for name in (*RAW_SCHEMAS, *DATASETS)}

    def write(self, name: str, df: DataFrame, watch: Callable[[DataFrame], DataFrame] = lambda df: df) -> DataFrame:
        sort_by, month = MARTS.get(name, ((), None))
        path = sinks.write_table(
            df, self.folder, layer_of(name), name, sort_by=sort_by, month_of=month, watch=watch
        )
        written = self.spark.read.parquet(path)
        return written.drop(sinks.MONTH) if month else written

    def build(self) -> dict[str, DataFrame]:
        """Write every staging, intermediate and mart table to its layer, each once, and read it back."""
        for name in DATASETS:
            df = self.table(name)
            if name not in SHARED:
                self._tables[name] = self.write(name, df)
        return {name: self._tables[name] for name in DATASETS}

    def check_table(self, name: str, report: BuildReport, skip: Sequence[checks.Check] = ()) -> bool:
        """Run the declared checks of a table but ``skip``, store the failing rows of those that fail.

        Whether what depends on the table may go on.
        """
        declared = {c.name: c for c in catalogue.declared(name) if c not in skip}
        if not declared:
            return True
        needed = {name, *(c.parent for c in declared.values() if c.parent)}
        tables = {n: self.table(n) for n in needed}
        rows = checks.check_table(list(declared.values()), tables).collect()  # one row per check
        report.results += rows
        failed = [declared[r.check_name] for r in rows if not r.passed]
        self._store([c for c in failed if c.kind in checks.ROW_KINDS], name, report)
        for check in failed:
            if check.kind not in checks.ROW_KINDS:
                report.failures[name, check.name] = checks.store_failures(check, tables, self.folder)
        return all(r.passed or not r.blocking or r.severity != "error" for r in rows)

    def check_together(self, names: Sequence[str], report: BuildReport) -> None:
        """Run the declared checks of several tables as one query, store the failing rows of those that fail.

        Checks run side by side in it, and an exchange that several of them need, as the keys of a raw table and of
        its staging table, is made once. Tables that are still to be written, and those of ``REREAD``, are written
        with tags of the row checks that their rows fail.
        """
        missing = [n for n in names if n in DEPENDS and (n in SHARED and n not in self._tables or n in REREAD - self._reread)]
        tagged = self._write_side_by_side(missing)
        self._reread |= REREAD & {*missing}
        declared = {(c.table, c.name): c for name in names for c in catalogue.declared(name)}
        by_row = {n: [c for c in declared.values() if c.table == n and c.kind in checks.ROW_KINDS] for n in tagged}
        apart = [c for c in declared.values() if c not in by_row.get(c.table, ())]
        tables = {n: self.table(n) for n in {c.table for c in apart} | {c.parent for c in apart if c.parent}}
        parts = [checks.check_tags(tagged[n], own) for n, own in by_row.items() if own]
        parts += [checks.run_checks(apart, tables)] if apart else []
        rows = reduce(DataFrame.unionByName, parts).collect() if parts else []  # one row per check
        report.results += rows
        failed = [declared[r.table_name, r.check_name] for r in rows if not r.passed]
        for name in names:
            own = [c for c in failed if c.table == name and c.kind in checks.ROW_KINDS]
            if name in tagged:
                self._store(own, name, report, _failing(tagged[name]))
            else:
                self._store(own, name, report)
        for check in failed:
            if check.kind not in checks.ROW_KINDS:
                report.failures[check.table, check.name] = checks.store_failures(check, tables, self.folder)

    def _write_side_by_side(self, names: Sequence[str]) -> dict[str, DataFrame]:
        """Write tables with the tags of their row checks, each as soon as those of ``names`` that it reads are there."""
        begun: dict[str, Future] = {}

        def made(name: str, first: Sequence[Future]) -> DataFrame:
            for other in first:
                other.result()
            return self._tagged(name)

        with ThreadPoolExecutor(AT_ONCE) as pool:
            # In the order of ``names`` a table comes after those that it reads, so none waits for one not yet begun.
            for name in names:
                first = [begun[d] for d in DEPENDS[name] if d in begun]
                begun[name] = pool.submit(inheritable_thread_target(self.spark)(made), name, first)
        return {name: future.result() for name, future in begun.items()}

    def _store(
        self, failed: list[checks.Check], name: str, report: BuildReport, rows: DataFrame | None = None
    ) -> None:
        """Failing rows of row checks: one pass for all of them over the table, or over those of its ``rows``."""
        if failed:
            stored = checks.store_row_failures(failed, self.table(name) if rows is None else rows, self.folder)
            report.failures |= {(name, c.name): path for c, path in stored.items()}

    def build_checked(self) -> BuildReport:
        """Like ``build``, with the declared checks of each table.

        Written rows carry a tag of the row checks they fail, so the table is not read again for these, but where
        some do. Checks that compare rows or tables run after the write, and raw tables, which are not written, are
        read once for all their row checks. Failing rows are stored for every failing check. A blocking check
        of severity error keeps all tables that depend on its table from being built; the rest is built, then
        BuildStopped raised.
        """
        report = BuildReport()
        at_fault: dict[str, str] = {}
        for name in (*RAW_SCHEMAS, *DATASETS):
            cause = next((at_fault[d] for d in DEPENDS.get(name, ()) if d in at_fault), None)
            if cause:
                at_fault[name] = report.stopped_by[name] = cause
                continue
            done = []
            if name in DEPENDS and not (name in SHARED and name in self._tables):
                done = self._write_tagged(name, report)
            if not self.check_table(name, report, skip=done):
                at_fault[name] = name
        if report.stopped_by:
            raise BuildStopped(report)
        return report

    def _write_tagged(self, name: str, report: BuildReport) -> list[checks.Check]:
        """Write a table and report on its row checks, which are returned."""
        tagged = self._tagged(name)
        by_row = [c for c in catalogue.declared(name) if c.kind in checks.ROW_KINDS]
        if by_row:
            rows = checks.check_tags(tagged, by_row).collect()  # one row per check
            report.results += rows
            self._store([c for c, row in zip(by_row, rows) if not row.passed], name, report, _failing(tagged))
        return by_row

    def _tagged(self, name: str) -> DataFrame:
        """Write a table with the tags of its row checks, if it has any; the rows with their tags."""
        by_row = [c for c in catalogue.declared(name) if c.kind in checks.ROW_KINDS]
        with self._making(name):
            if not by_row:
                self._tables[name] = self.write(name, self.define(name))
                return self._tables[name]
            tagged = self.write(name, self.define(name), lambda df: checks.with_tag(df, by_row))
            self._tables[name] = tagged.drop(checks.TAG)
            return tagged

    def _partials(self, kind: type, name: str):
        """The partials of a wide table, each written once for all marts that merge them."""
        with self._making(kind):
            if kind not in self.memo:
                made = kind.of(self.table(name))
                self.memo[kind] = kind(
                    **{f.name: self.write(f"{name}_{f.name}", getattr(made, f.name)) for f in fields(kind)}
                )
            return self.memo[kind]

    def heavy_orders(self) -> list:
        """Orders with so many items that no task should take them all, measured once."""
        with self._making("heavy_orders"):
            if "heavy_orders" not in self.memo:
                self.memo["heavy_orders"] = skew.heavy_keys(self.table("stg_order_items"), "order_id")
            return self.memo["heavy_orders"]

    def heavy_payments(self) -> list:
        """The same for payments, with NULL if so many have no order."""
        with self._making("heavy_payments"):
            if "heavy_payments" not in self.memo:
                payments = self.table("order_payments")
                heavy = skew.heavy_keys(payments, "order_id")
                self.memo["heavy_payments"] = heavy + [None] * skew.null_is_heavy(payments, "order_id")
            return self.memo["heavy_payments"]

    def define(self, name: str) -> DataFrame:
        """The plan of a staging, intermediate or mart table over its inputs."""
        return self._definitions()[name]()

    def _definitions(self) -> dict[str, Callable[[], DataFrame]]:
        t = self.table
        return {
            "stg_customers": lambda: staging.stg_customers(t("customers")),
            "stg_geolocation": lambda: staging.stg_geolocation(t("geolocation")),
            "stg_order_items": lambda: staging.stg_order_items(t("order_items")),
            "stg_order_payments": lambda: staging.stg_order_payments(
                t("order_payments"), self.heavy_payments()
            ),
            "stg_order_reviews": lambda: staging.stg_order_reviews(t("order_reviews")),
            "stg_orders": lambda: staging.stg_orders(t("orders"), self.settings),
            "stg_products": lambda: staging.stg_products(
                t("products"), t("product_category_name_translation")
            ),
            "stg_sellers": lambda: staging.stg_sellers(t("sellers")),
            "int_seller_points": lambda: intermediate.seller_points(t("stg_sellers"), t("stg_geolocation")),
            "int_order_facts": lambda: intermediate.order_item_facts(
                t("stg_order_items"),
                t("stg_orders"),
                t("stg_customers"),
                t("stg_sellers"),
                t("stg_geolocation"),
                self.heavy_orders(),
                t("int_seller_points"),
            ),
            "int_order_distance": lambda: intermediate.int_order_distance(t("int_order_facts")),
            "int_orders_enriched": lambda: intermediate.int_orders_enriched(
                t("stg_orders"),
                t("stg_customers"),
                t("int_order_facts"),
                t("stg_order_payments"),
                t("stg_order_reviews"),
                t("seed_state_region"),
                self.settings,
            ),
            "int_order_items_enriched": lambda: intermediate.int_order_items_enriched(
                t("stg_order_items"),
                t("int_orders_enriched"),
                t("stg_products"),
                t("stg_sellers"),
                t("seed_state_region"),
            ),
            "mart_daily_state_metrics": lambda: marts.mart_daily_state_metrics(
                t("int_orders_enriched"), self._partials(partials.OrderPartials, "int_orders_enriched")
            ),
            "mart_delivery_quality_by_category": lambda: marts.mart_delivery_quality_by_category(
                t("int_order_items_enriched"), self._partials(partials.ItemPartials, "int_order_items_enriched")
            ),
            "mart_delivery_quality_by_state": lambda: marts.mart_delivery_quality_by_state(
                t("int_orders_enriched"), self._partials(partials.OrderPartials, "int_orders_enriched")
            ),
            "mart_hourly_order_pattern": lambda: marts.mart_hourly_order_pattern(t("int_orders_enriched")),
            "mart_customer_value_profile": lambda: marts.mart_customer_value_profile(
                t("int_orders_enriched"), self.settings
            ),
            "mart_seller_analytics": lambda: marts.mart_seller_analytics(
                t("int_order_items_enriched"), self.settings
            ),
            "mart_order_features": lambda: marts.mart_order_features(
                t("int_orders_enriched"), t("stg_order_items"), t("stg_products"), self.heavy_orders()
            ),
            "mart_daily_order_anomalies": lambda: marts.mart_daily_order_anomalies(
                t("stg_orders"), self.anomalies
            ),
        }


def _failing(tagged: DataFrame) -> DataFrame:
    """Rows that fail a check, of a table written with tags."""
    return tagged.where(f"{checks.TAG} > 0").drop(checks.TAG)


def _warn_about_partitions(spark: SparkSession, input_bytes: int) -> None:
    """Warns when the session's shuffle partitions are far too few for the raw tables."""
    each = input_bytes / int(spark.conf.get("spark.sql.shuffle.partitions"))
    if each > 8 * PARTITION_BYTES:
        warnings.warn(
            f"shuffle partitions of {each / 2**30:.1f} GiB; build the session with"
            " tradewind.session.cluster_settings(input_bytes)",
            stacklevel=3,
        )
