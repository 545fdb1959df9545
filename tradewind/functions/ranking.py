"""Order statistics over groups of any size: prefix totals and exact percentiles.

A window over a whole group (or over no group at all) sorts that group in one task. Here the rows
are first collapsed to one per distinct value and cut into value slices by a histogram over all rows,
so that a group holding most of the data is cut into many slices. The histogram has a bounded number
of buckets on a logarithmic scale, and a bucket that holds more than its share of the values is refined
into even parts between its own smallest and largest value. Windows run inside one slice, and a small
table of slice totals carries the offsets between them. Slices only spread the work: every result is exact.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SLICES = 4096  # parts that buckets are refined into, on top of one per bucket
PER_OCTAVE = 32  # buckets between a value and its double
_ABOVE = 1 << 16  # more than buckets between one and the smallest double


def join_on_keys(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """Join two frames on grouping keys, where NULL is a group like any other."""
    renamed = right.select(
        *[F.col(k).alias(f"__{k}") for k in keys], *[c for c in right.columns if c not in keys]
    )
    same = reduce(lambda a, b: a & b, [_same(k) for k in keys])
    return left.join(renamed, same, how).drop(*[f"__{k}" for k in keys])


def _same(key: str) -> Column:
    """Key equality that also pairs NULL with NULL; a slice is never NULL."""
    if key == "slice":
        return F.col(key) == F.col(f"__{key}")
    return F.col(key).eqNullSafe(F.col(f"__{key}"))


def coarse_bucket(value: Column) -> Column:
    """A whole number that never falls as the value grows: a logarithmic scale on both sides of zero.

    NaN comes last, as in sorting. The logarithm is monotone also after rounding.
    """
    size = F.floor(F.least(F.log(F.abs(value)), F.lit(710.0)) * (PER_OCTAVE / math.log(2))) + _ABOVE
    return (
        F.when(F.isnan(value), F.lit(2 * _ABOVE))
        .when(value > 0, size)
        .when(value < 0, -size)
        .otherwise(F.lit(0))
        .cast("bigint")
    )


def _sliced(counts: DataFrame, value: str, weight: Column) -> DataFrame:
    """Add ``slice``, a whole number that never falls as the value grows.

    The weight is always true; naming it keeps every consumer on the same columns of ``counts``,
    so that the shuffle that builds the counts is planned once and reused.
    """
    v = F.col(value)
    histogram = (
        counts.where(weight)
        .groupBy(coarse_bucket(v).alias("__bucket"))
        .agg(F.count(F.lit(1)).alias("__rows"), F.min(v).alias("__low"), F.max(v).alias("__high"))
    )
    # At most four times _ABOVE buckets, in practice hundreds: one task adds them up, all tasks get them.
    share = F.col("__rows") * SLICES / F.sum("__rows").over(Window.partitionBy(F.lit(0)))
    refined = histogram.select(
        F.col("__bucket").alias("__of"), "__low", (F.col("__high") - F.col("__low")).alias("__wide"), F.ceil(share).alias("__parts")
    )
    inside = F.floor(F.try_divide((v - F.col("__low")) * F.col("__parts"), F.col("__wide")))
    # Values that are all equal, infinite or NaN have one part.
    finite = (F.col("__wide") > 0) & (F.col("__wide") < float("inf"))
    part = F.when(finite, F.least(inside, F.col("__parts") - 1)).otherwise(0)
    return (
        counts.withColumn("__bucket", coarse_bucket(v))
        .join(F.broadcast(refined), F.col("__bucket") == F.col("__of"))
        .select(*counts.columns, (F.col("__bucket") * (2 * SLICES) + part).cast("bigint").alias("slice"))
    )


def prefix_totals(
    counts: DataFrame, keys: Sequence[str], value: str, measures: Sequence[str]
) -> DataFrame:
    """Add ``<m>_below`` (total of m over smaller values of the same keys) and ``<m>_total``.

    ``counts`` has one row per keys and value; the measures are non-negative counts.
    """
    weight = reduce(lambda a, b: a & b, [F.col(m) >= 0 for m in measures])
    sliced = _sliced(counts, value, weight)
    offsets = _slice_offsets(sliced, keys, measures)
    inside = Window.partitionBy(*keys, "slice").orderBy(value).rowsBetween(Window.unboundedPreceding, -1)
    joined = join_on_keys(sliced, offsets, [*keys, "slice"])
    return joined.select(
        *counts.columns,
        *[
            (F.col(f"{m}_offset") + F.coalesce(F.sum(m).over(inside), F.lit(0))).alias(f"{m}_below")
            for m in measures
        ],
        *[f"{m}_total" for m in measures],
    )


def _slice_offsets(sliced: DataFrame, keys: Sequence[str], measures: Sequence[str]) -> DataFrame:
    """Per keys and slice: totals before the slice, of the slice, and of all slices."""
    totals = sliced.groupBy(*keys, "slice").agg(*[F.sum(m).alias(f"{m}_slice") for m in measures])
    # At most as many rows per key as there are slices.
    group = Window.partitionBy(*keys)
    before = group.orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    return totals.select(
        *keys,
        "slice",
        *[f"{m}_slice" for m in measures],
        *[F.coalesce(F.sum(f"{m}_slice").over(before), F.lit(0)).alias(f"{m}_offset") for m in measures],
        *[F.sum(f"{m}_slice").over(group).alias(f"{m}_total") for m in measures],
    )


def grouped_percentiles(
    df: DataFrame, keys: Sequence[str], value: str, wanted: Mapping[str, float]
) -> DataFrame:
    """Exact interpolated percentiles of ``value`` per keys, as columns; groups without values give no row.

    ``wanted`` maps a column to its quantile. All of them share one pass, one slicing and one table of
    slice totals.
    """
    counts = (
        df.where(F.col(value).isNotNull())
        .groupBy(*keys, F.col(value).cast("double").alias("value"))
        .agg(F.count(F.lit(1)).alias("n"))
    )
    return percentiles_of_counts(counts, keys, wanted)


def percentiles_of_counts(counts: DataFrame, keys: Sequence[str], wanted: Mapping[str, float]) -> DataFrame:
    """Percentiles as of rows of which ``counts`` has one per keys and ``value``, with their number ``n``."""
    sliced = _sliced(counts, "value", F.col("n") > 0)
    positions = F.array(*[F.lit(float(q)) * (F.col("n_total") - 1) for q in wanted.values()])
    # Only the slices holding the wanted ranks, one or two per quantile, are joined back and sorted.
    holds = F.exists(
        "positions",
        lambda p: (F.col("n_offset") <= F.ceil(p)) & (F.col("n_offset") + F.col("n_slice") > F.floor(p)),
    )
    slices = (
        _slice_offsets(sliced, keys, ["n"])
        .withColumn("positions", positions)
        .where(holds)
        .select(*keys, "slice", "n_offset", "positions")
    )
    inside = Window.partitionBy(*keys, "slice").orderBy("value").rowsBetween(Window.unboundedPreceding, -1)
    ranked = join_on_keys(sliced, slices, [*keys, "slice"]).withColumn(
        "below", F.col("n_offset") + F.coalesce(F.sum("n").over(inside), F.lit(0))
    )

    def value_at(rank: Column) -> Column:
        return F.min(F.when((F.col("below") <= rank) & (rank < F.col("below") + F.col("n")), F.col("value")))

    ends, columns = [], []
    for i, name in enumerate(wanted):
        position = F.col("positions")[i]
        ends += [
            value_at(F.floor(position)).alias(f"low{i}"),
            value_at(F.ceil(position)).alias(f"high{i}"),
            F.max(position - F.floor(position)).alias(f"part{i}"),
        ]
        low, high = F.col(f"low{i}"), F.col(f"high{i}")
        between = F.when(low == high, low).otherwise(low + (high - low) * F.col(f"part{i}"))  # also where infinite
        columns.append(between.alias(name))
    return ranked.groupBy(*keys).agg(*ends).select(*keys, *columns)


def grouped_percentile(
    df: DataFrame, keys: Sequence[str], value: str, q: float = 0.95, name: str = "percentile"
) -> DataFrame:
    """One exact interpolated percentile of ``value`` per keys."""
    return grouped_percentiles(df, keys, value, {name: q})
