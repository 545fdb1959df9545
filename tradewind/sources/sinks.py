"""Table sinks: one folder or database per layer, full or partial overwrite, physical layout, comments.

``write_table`` replaces a folder in place, which is enough for a run's own tables. ``publish_table`` is for
tables that others read meanwhile: it writes a new version beside the old one and then switches a small
manifest file, so a reader sees the old version or the new one, and a killed write leaves the old one.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Mapping, Sequence
from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

MONTH = "purchase_ym"
MANIFEST = "_current"


def with_comments(df: DataFrame, comments: Mapping[str, str]) -> DataFrame:
    for name, comment in comments.items():
        df = df.withMetadata(name, {"comment": comment})
    return df


def arrange(df: DataFrame, sort_by: Sequence[str] = (), month_of: str | None = None) -> DataFrame:
    """Rows clustered by month (if asked) and sorted by the key inside each file.

    ``rebalance`` keeps one month together only while it fits a file: adaptive execution splits a
    month that holds much of the data over several tasks. NULL sort keys are allowed.
    """
    if month_of:
        df = df.withColumn(MONTH, F.date_format(month_of, "yyyyMM")).hint("rebalance", MONTH)
    order = ([MONTH] if month_of else []) + list(sort_by)
    return df.sortWithinPartitions(*[F.asc_nulls_last(c) for c in order]) if order else df


def write_table(
    df: DataFrame,
    folder: str,
    layer: str,
    name: str,
    *,
    sort_by: Sequence[str] = (),
    month_of: str | None = None,
    comments: Mapping[str, str] | None = None,
    watch: Callable[[DataFrame], DataFrame] = lambda df: df,
) -> str:
    """Overwrite ``<folder>/<layer>/<name>`` as parquet and return that path.

    ``watch`` may add columns to the rows as they are written, after any shuffle.
    """
    path = f"{folder}/{layer}/{name}"
    writer = watch(arrange(with_comments(df, comments or {}), sort_by, month_of)).write.mode("overwrite")
    if month_of:
        writer = writer.partitionBy(MONTH)
    writer.parquet(path)
    return path


def replace_months(df: DataFrame, path: str, *, month_of: str, sort_by: Sequence[str] = ()) -> None:
    """Replace the months that occur in ``df`` in a table laid out by month; other months stay untouched."""
    writer = arrange(df, sort_by, month_of).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.partitionBy(MONTH).parquet(path)


def months_between(start: str, end: str) -> Column:
    """Months that the half-open window [start, end) touches, as a condition on the partition column."""
    last = datetime.fromisoformat(end) - timedelta(microseconds=1)
    return F.col(MONTH).between(int(f"{datetime.fromisoformat(start):%Y%m}"), int(f"{last:%Y%m}"))


# --- versions ------------------------------------------------------------------------------------


def _file(spark: SparkSession, path: str):
    """(Hadoop path, its file system)."""
    found = spark._jvm.org.apache.hadoop.fs.Path(path)
    return found, found.getFileSystem(spark._jsc.hadoopConfiguration())


def _read_manifest(spark: SparkSession, base: str) -> str | None:
    path, files = _file(spark, f"{base}/{MANIFEST}")
    if not files.exists(path):
        return None
    stream = files.open(path)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8").strip()
    finally:
        stream.close()


def _switch_manifest(spark: SparkSession, base: str, version: str) -> None:
    """Write the manifest beside its place and rename it over the old one, which is one step."""
    new, files = _file(spark, f"{base}/{MANIFEST}-{uuid.uuid4().hex}")
    stream = files.create(new, False)
    stream.write(bytearray(version.encode()))
    stream.close()
    fs = spark._jvm.org.apache.hadoop.fs
    overwrite = spark.sparkContext._gateway.new_array(fs.Options.Rename, 1)
    overwrite[0] = fs.Options.Rename.OVERWRITE
    old = fs.Path(f"{base}/{MANIFEST}")
    fs.FileContext.getFileContext(new.toUri(), spark._jsc.hadoopConfiguration()).rename(new, old, overwrite)


def publish_table(
    spark: SparkSession, df: DataFrame, folder: str, layer: str, name: str, *, keep: int = 2, **options
) -> str:
    """Write a new version of ``<folder>/<layer>/<name>`` and make it the current one; returns its path.

    ``options`` are those of ``write_table``. ``df`` may read the table itself. The last ``keep`` versions
    stay for readers that began before; older ones, and leftovers of killed writes, are removed afterwards.
    """
    base = f"{folder}/{layer}/{name}"
    before = _read_manifest(spark, base)
    number = int(before.split("-")[1]) + 1 if before else 1
    version = f"v-{number:010d}-{uuid.uuid4().hex}"
    path = write_table(df, folder, f"{layer}/{name}", version, **options)
    _switch_manifest(spark, base, version)
    _drop_versions(spark, base, number - keep)
    return path


def published_table(spark: SparkSession, folder: str, layer: str, name: str) -> DataFrame:
    """The current version of a published table, as it is when it is asked for."""
    base = f"{folder}/{layer}/{name}"
    version = _read_manifest(spark, base)
    if version is None:
        raise FileNotFoundError(f"nothing published at {base}")
    return spark.read.parquet(f"{base}/{version}")


def _drop_versions(spark: SparkSession, base: str, upto: int) -> None:
    """Remove versions numbered ``upto`` or less."""
    path, files = _file(spark, base)
    for entry in files.listStatus(path):
        name = entry.getPath().getName()
        if name.startswith("v-") and int(name.split("-")[1]) <= upto:
            files.delete(entry.getPath(), True)


# --- catalog -------------------------------------------------------------------------------------


def save_table(
    spark: SparkSession,
    df: DataFrame,
    layer: str,
    name: str,
    *,
    sort_by: Sequence[str] = (),
    month_of: str | None = None,
    bucket_by: tuple[int, str] | None = None,
    comment: str | None = None,
    comments: Mapping[str, str] | None = None,
) -> str:
    """Overwrite catalog table ``<layer>.<name>``; buckets let later joins on that key skip a shuffle."""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {layer}")
    writer = arrange(with_comments(df, comments or {}), sort_by, month_of).write.mode("overwrite")
    if month_of:
        writer = writer.partitionBy(MONTH)
    if bucket_by:
        writer = writer.bucketBy(*bucket_by)
    writer.format("parquet").saveAsTable(f"{layer}.{name}")
    if comment:
        text = comment.replace("'", "\\'")
        spark.sql(f"COMMENT ON TABLE {layer}.{name} IS '{text}'")
    return f"{layer}.{name}"
