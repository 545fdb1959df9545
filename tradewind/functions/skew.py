"""Keys that hold so many rows that no single task should take all of them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

HEAVY_ROWS = 1 << 20
TRACKED, MOST = 10_000, 1_000


def heavy_keys(df: DataFrame, column: str, at_least: int = HEAVY_ROWS) -> list:
    """Values of ``column`` with at least ``at_least`` rows, measured in one narrow scan.

    A frequent-items sketch of ``TRACKED`` entries per task, merged to one row, names the candidates: every
    value with more than about one row in three thousand is among them. Fewer than a thousand values can
    be that frequent, and rarer ones are no hot spots. Candidates are then counted exactly. NULL is no key.
    """
    found = df.where(F.col(column).isNotNull()).agg(F.expr(f"approx_top_k(`{column}`, {MOST}, {TRACKED})").alias("top"))
    row = found.first()
    candidates = [t["item"] for t in row["top"] or [] if t["count"] >= at_least]
    if not candidates:
        return []
    counted = df.where(F.col(column).isin(candidates)).groupBy(column).agg(F.count(F.lit(1)).alias("n"))
    return sorted(r[column] for r in counted.where(F.col("n") >= at_least).collect())


def split_keys(df: DataFrame, column: str, heavy: Sequence) -> tuple[DataFrame, DataFrame]:
    """Rows of ordinary keys and of the (at most a thousand) heavy ones, of which NULL may be one."""
    named = F.col(column).isin([k for k in heavy if k is not None])
    hot = F.when(F.col(column).isNull(), F.lit(None in heavy)).otherwise(named)
    return df.where(~hot), df.where(hot)


def null_is_heavy(df: DataFrame, column: str, at_least: int = HEAVY_ROWS) -> bool:
    """Whether at least so many rows have no key."""
    return df.where(F.col(column).isNull()).agg(F.count(F.lit(1)).alias("n")).first()["n"] >= at_least
