"""Daily series per key: days without rows filled in, and statistics of the days before.

A series has one row per key and calendar day, so a window over one key does not grow with the rows
that were counted. Filling and rolling windows share one distribution by key: a row writes the empty
days behind it itself, so there is no calendar to join. Without keys there is one series, which runs in
one task over one row per day.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def fill_days(
    df: DataFrame, day: str, measures: Sequence[str], keys: Sequence[str] = (), *, shared: bool = False
) -> DataFrame:
    """``df`` (one row per keys and day) plus a row of zero ``measures`` for every missing day.

    Every series runs from its own first to its own last day; with ``shared`` from the first to the last
    day of all, so that a key that falls silent counts zero until the end. NULL keys are a key like any
    other, rows without a day are left out, and of an empty table nothing is filled.
    """
    dated = df.where(F.col(day).isNotNull())
    series = Window.partitionBy(*keys).orderBy(day)
    first, last = F.col(day), F.col(day)
    if shared:
        bounds = dated.agg(F.min(day).alias("__first"), F.max(day).alias("__last"))  # one row
        dated = dated.crossJoin(F.broadcast(bounds))
        first, last = F.col("__first"), F.col("__last")
    gaps = dated.select(
        *keys,
        *measures,
        F.col(day).alias("__own"),
        F.when(F.lag(day).over(series).isNull(), first).otherwise(F.col(day)).alias("__from"),
        F.coalesce(F.date_sub(F.lead(day).over(series), 1), last).alias("__to"),
    )
    filled = gaps.select("*", F.explode(F.sequence("__from", "__to")).alias(day))
    return filled.select(
        *keys, day, *[F.when(F.col(day) == F.col("__own"), F.coalesce(m, F.lit(0))).otherwise(0).alias(m) for m in measures]
    )


def days_before(day: str, days: int, keys: Sequence[str] = ()):
    """The ``days`` rows before each row of its series."""
    return Window.partitionBy(*keys).orderBy(day).rowsBetween(-days, -1)


def rolling(df: DataFrame, value: str, day: str, days: int, keys: Sequence[str] = ()) -> DataFrame:
    """Add ``rolling_mean``, ``rolling_std`` (sample) and ``z_score`` of ``value`` against the days before.

    Mean and deviation are NULL until ``days`` days exist; the score is NULL where the deviation is NULL or 0.
    """
    before = days_before(day, days, keys)
    full = F.count(value).over(before) == days
    return df.withColumns(
        {
            "rolling_mean": F.when(full, F.avg(value).over(before)),
            "rolling_std": F.when(full, F.stddev_samp(value).over(before)),
        }
    ).withColumn("z_score", F.when(F.col("rolling_std") > 0, (F.col(value) - F.col("rolling_mean")) / F.col("rolling_std")))


def deviations(score: str, threshold: float) -> dict[str, Column]:
    """``is_anomaly`` (0 where there is no score) and ``anomaly_direction`` (spike, drop, or NULL)."""
    far = F.coalesce(F.abs(score) >= threshold, F.lit(False))
    return {
        "is_anomaly": far.cast("int"),
        "anomaly_direction": F.when(far, F.when(F.col(score) > 0, "spike").otherwise("drop")),
    }
