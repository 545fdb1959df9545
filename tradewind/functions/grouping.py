"""Several kinds of measures over the same groups, each aggregated in the way that suits it.

One aggregation over everything would be dragged down to its weakest part: a minimum over strings
turns hash aggregation into sorting, and a distinct count shuffles all other measures per distinct
value. So sums and counts collapse to one row per group before any shuffle, distinct counts travel
as bare (group, value) pairs, labels as their few distinct values, and the results, one row per
group each, are merged.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tradewind.functions.ranking import grouped_percentiles


def merge_groups(parts: Sequence[DataFrame], keys: Sequence[str]) -> DataFrame:
    """One row per keys with the columns of all parts; each part has at most one row per keys.

    The parts are stacked and grouped once. Unlike a chain of joins this is a single shuffle of
    group rows, and NULL keys need no special equality.
    """
    stacked = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    return stacked.groupBy(*keys).agg(*[F.max(c).alias(c) for c in stacked.columns if c not in keys])


def collapse(
    df: DataFrame,
    key: str,
    measures: Mapping[str, Column],
    prepared: Callable[[DataFrame], DataFrame] = lambda df: df,
) -> DataFrame:
    """One row per key with all measures, sets among them, for keys with few rows each.

    Rows are exchanged once, sorted by the key and read key by key, so no more than the rows of one key is
    held beside the sort. A plain aggregation with a set in it hashes, gives that up after a few keys, and then
    sorts rows together with their unfinished results, twice. NULL is a key. ``prepared`` may add columns to the
    rows where they are after the exchange, also by windows within a key.
    """
    per_key = Window.partitionBy(key)
    spread = prepared(df.repartition(key)).select(key, *[m.over(per_key).alias(name) for name, m in measures.items()])
    whole = spread.select(key, F.struct(*measures).alias("whole"))  # a struct is aggregated in sorted order
    return whole.groupBy(key).agg(F.first("whole").alias("whole")).select(key, "whole.*")


def group_metrics(
    df: DataFrame,
    keys: Sequence[str],
    measures: Sequence[Column],
    *,
    distinct: Mapping[str, str] | None = None,
    labels: Mapping[str, str] | None = None,
    percentiles: Mapping[str, tuple[str, float]] | None = None,
    more: Sequence[DataFrame] = (),
) -> DataFrame:
    """Measures, distinct counts, first labels (string minimum) and exact percentiles per keys.

    ``distinct`` and ``labels`` map an output name to a column, ``percentiles`` to (column, q);
    ``more`` are further frames with one row per keys. NULL keys are a group.
    """
    parts = [df.groupBy(*keys).agg(*measures)]
    # One distinct column at a time: several in one aggregation would expand every row by their number.
    for name, column in (distinct or {}).items():
        parts.append(df.groupBy(*keys).agg(F.countDistinct(column).alias(name)))
    if labels:
        parts.append(
            df.select(*keys, *labels.values())
            .distinct()
            .groupBy(*keys)
            .agg(*[F.min(column).alias(name) for name, column in labels.items()])
        )
    by_column: dict[str, dict[str, float]] = {}
    for name, (column, q) in (percentiles or {}).items():
        by_column.setdefault(column, {})[name] = q
    for column, wanted in by_column.items():
        parts.append(grouped_percentiles(df, keys, column, wanted))
    return merge_groups([*parts, *more], keys)
