"""Helpers shared by the operators: written intermediate tables and connected components."""

from __future__ import annotations

import sys
import types
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tradewind.session import shared_folder

# Words are runs of anything but ASCII white space; ``bytes.split()`` cuts at the same six characters.
WORD = "[^\\x20\\x09-\\x0D]+"
ARROW_BYTES = 4 << 20  # bytes of a batch that goes to a Python worker
_ARROW = "spark.sql.execution.arrow.maxBytesPerBatch"
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def freed_shuffles(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of the jobs inside go when each job ends, since its result is a written table."""
    before = spark.conf.get(_CLEANUP, None)
    spark.conf.set(_CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.set(_CLEANUP, before) if before is not None else spark.conf.unset(_CLEANUP)


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a parquet table in the shared folder: cuts lineage and survives lost executors."""
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/llm-{name}-{uuid.uuid4().hex}"
    with freed_shuffles(spark):
        df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def small_batches(df: DataFrame) -> DataFrame:
    """``df``, whose session from now on sends texts to Python in batches of at most ``ARROW_BYTES``, or one row.

    The default of 64 MB is held several times over by each task: in the JVM, in the worker, and as results.
    """
    conf = df.sparkSession.conf
    conf.set(_ARROW, str(ARROW_BYTES))
    return df


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return small_batches(spark.read.parquet(f"{sf_dir}/documents.parquet"))


def squeezed(body: bytes) -> bytes:
    """Bytes compressed before they are written or shuffled; ``unsqueezed`` needs their length."""
    return pa.Codec("zstd", compression_level=5).compress(body, asbytes=True) if body else b""


def unsqueezed(body: bytes, length: int) -> bytes:
    return pa.decompress(body, decompressed_size=length, codec="zstd", asbytes=True) if length else b""


def once_per_worker(name: str, make: Callable):
    """What ``make`` returns, made once in a Python worker and kept for its further tasks.

    Functions reach a worker anew with every task, so what they load is kept in a module of its own.
    """
    kept = sys.modules.setdefault("_tradewind_worker", types.ModuleType("_tradewind_worker"))
    if not hasattr(kept, name):
        setattr(kept, name, make())
    return getattr(kept, name)


def text_or_empty(column: str | Column) -> Column:
    """Null text is an empty text."""
    return F.coalesce(F.col(column) if isinstance(column, str) else column, F.lit(""))


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node but the roots themselves; a root is its component's smallest node.

    ``edges`` has two long columns, in any order, with repeats allowed. Each round every node hands
    its larger neighbours, then its smaller ones, over to the smallest one it knows, until all edges
    point at a root. Minima are partial aggregates and the joins have one row per node on one side,
    so a hub with any number of neighbours is split by adaptive execution; nothing is gathered per node.
    """
    a, b = edges.columns
    star = written(
        edges.where(F.col(a) != F.col(b))
        .select(F.greatest(a, b).alias("node"), F.least(a, b).alias("root"))
        .distinct(),
        "edges",
    )
    seen = _digest(star)
    while seen[0]:
        star = written(_small_star(_large_star(star)), "edges")
        now = _digest(star)
        if now == seen:
            break
        seen = now
    return star


def _digest(star: DataFrame) -> tuple[int, int]:
    row = star.agg(
        F.count(F.lit(1)).alias("n"), F.bit_xor(F.xxhash64("node", "root")).alias("bits")
    ).first()
    return row["n"], row["bits"]


def _large_star(star: DataFrame) -> DataFrame:
    both = star.select(F.col("node").alias("x"), F.col("root").alias("y")).unionAll(
        star.select(F.col("root").alias("x"), F.col("node").alias("y"))
    )
    least = both.groupBy("x").agg(F.min("y").alias("m")).select(F.col("x").alias("k"), F.least("k", "m").alias("m"))
    return (
        both.join(least, F.col("x") == F.col("k"))
        .where(F.col("y") > F.col("x"))
        .select(F.col("y").alias("node"), F.col("m").alias("root"))
        .where("node != root")
    )


def _small_star(star: DataFrame) -> DataFrame:
    least = star.groupBy("node").agg(F.min("root").alias("m")).withColumnRenamed("node", "k")
    moved = (
        star.join(least, F.col("node") == F.col("k"))
        .select(F.col("root").alias("node"), F.col("m").alias("root"))
        .where("node != root")
    )
    return moved.unionAll(least.select(F.col("k").alias("node"), F.col("m").alias("root"))).distinct()
