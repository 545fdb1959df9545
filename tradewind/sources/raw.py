"""Raw tables from files, read by column name against their declared schemas."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, StringType, StructField, StructType

from tradewind.config import Settings
from tradewind.sources import sinks
from tradewind.sources.schemas import RAW_SCHEMAS

REJECTED = "rejected_row"


def _declared(name: str) -> StructType:
    return StructType.fromDDL(RAW_SCHEMAS[name])


def _path(folder: str, name: str, fmt: str) -> str:
    return f"{folder.rstrip('/')}/{name}.{fmt}"


def _require(name: str, present: list[str]) -> None:
    missing = [f.name for f in _declared(name) if f.name not in present]
    if missing:
        raise ValueError(f"{name} lacks the columns {', '.join(missing)}; found {', '.join(present)}")


def _read_csv(spark: SparkSession, folder: str, name: str, **options) -> DataFrame:
    """All columns of the files in their own order, the declared ones with their types.

    The header of the first file gives the order and Spark compares that of every other file with it.
    """
    path = _path(folder, name, "csv")
    # Review texts hold quoted line breaks; only that table gives up split reads for them.
    shape = {"header": True, "escape": '"', "multiLine": name == "order_reviews"}
    present = spark.read.csv(path, **shape).columns
    _require(name, present)
    types = {f.name: f.dataType for f in _declared(name)}
    found = StructType([StructField(c, types.get(c, StringType())) for c in present])
    if "columnNameOfCorruptRecord" in options:
        found.add(REJECTED, StringType())
    return spark.read.schema(found).csv(path, enforceSchema=False, **shape, **options)


def load_raw(spark: SparkSession, folder: str, name: str, fmt: str = "csv") -> DataFrame:
    """One raw table: ``<folder>/<name>.csv`` (header row, multi-line text allowed) or ``.parquet``.

    Columns are found by name, in any order and among others. A missing column is an error, and so is
    a value that does not have its declared type, if a query reads its column; ``split_raw`` sets such rows
    aside instead, and ``ingest_raw`` looks at every value of every row.
    """
    names = [f.name for f in _declared(name)]
    if fmt == "csv":
        return _read_csv(spark, folder, name, mode="FAILFAST").select(*names)
    df = spark.read.format(fmt).load(_path(folder, name, fmt))
    _require(name, df.columns)
    return df.select(*[F.col(f.name).cast(f.dataType) for f in _declared(name)])


def split_raw(spark: SparkSession, folder: str, name: str) -> tuple[DataFrame, DataFrame]:
    """(rows that parse, ``rejected_row`` texts of those that do not) of a CSV table."""
    df = _read_csv(spark, folder, name, mode="PERMISSIVE", columnNameOfCorruptRecord=REJECTED)
    names = [f.name for f in _declared(name)]
    # Spark does not read the rejected text alone, so the parsed columns are read along.
    rejected = df.where(F.col(REJECTED).isNotNull()).select(*names, REJECTED)
    return df.where(F.col(REJECTED).isNull()).select(*names), rejected


@dataclass(frozen=True)
class Ingested:
    """Where the rows of a raw file went, and how many."""

    accepted: DataFrame
    rejected: DataFrame  # the declared columns, NULL where unparsable, and the text of the row
    per_file: DataFrame  # source_file, accepted, rejected
    accepted_rows: int
    rejected_rows: int


def ingest_raw(spark: SparkSession, folder: str, name: str, out: str) -> Ingested:
    """Parse every value of a CSV table once and write its rows as parquet below ``out``.

    Rows with an unparsable value in any column are set apart with their text. The counts per file are taken
    from what was written and stored beside the table, in ``<out>/<name>_accounting``.
    """
    names = [f.name for f in _declared(name)]
    df = _read_csv(spark, folder, name, mode="PERMISSIVE", columnNameOfCorruptRecord=REJECTED)
    bad = F.col(REJECTED).isNotNull()
    rows = df.select(*names, REJECTED, F.input_file_name().alias("source_file"), bad.alias("is_rejected"))
    path = f"{out}/{name}"
    rows.write.mode("overwrite").partitionBy("is_rejected").parquet(path)
    schema = StructType([*rows.schema.fields[:-1], StructField("is_rejected", BooleanType())])
    stored = spark.read.schema(schema).parquet(path)
    counts = stored.groupBy("source_file").agg(
        F.count_if(~F.col("is_rejected")).alias("accepted"), F.count_if("is_rejected").alias("rejected")
    )
    counts.write.mode("overwrite").parquet(f"{path}_accounting")
    per_file = spark.read.schema(counts.schema).parquet(f"{path}_accounting")
    total = per_file.agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("accepted", "rejected")]).first()
    return Ingested(
        stored.where(~F.col("is_rejected")).select(*names),
        stored.where("is_rejected").select(*names, REJECTED),
        per_file,
        total["accepted"],
        total["rejected"],
    )


def store_orders(orders: DataFrame, folder: str) -> str:
    """Raw orders laid out by month of purchase, so that windows read their months only."""
    return sinks.write_table(orders, folder, "raw", "orders", month_of="order_purchase_timestamp")


def stored_orders(spark: SparkSession, path: str, settings: Settings = Settings()) -> DataFrame:
    """Raw orders of a month layout; a purchase window prunes the months it does not touch."""
    stored = spark.read.parquet(path)
    if settings.start_date and settings.end_date:
        stored = stored.where(sinks.months_between(settings.start_date, settings.end_date))
    return purchase_window(stored.drop(sinks.MONTH), settings)


def load_all_raw(spark: SparkSession, folder: str, fmt: str = "csv") -> dict[str, DataFrame]:
    return {name: load_raw(spark, folder, name, fmt) for name in RAW_SCHEMAS}


def purchase_window(orders: DataFrame, settings: Settings) -> DataFrame:
    """Orders purchased in [start, end); all orders unless both bounds are set.

    A plain comparison with a literal, so that it reaches the file scan.
    """
    if not (settings.start_date and settings.end_date):
        return orders
    ts = F.col("order_purchase_timestamp")
    start = F.lit(settings.start_date).cast("timestamp_ntz")
    end = F.lit(settings.end_date).cast("timestamp_ntz")
    return orders.where((ts >= start) & (ts < end))
