"""Exact ranking metrics of scored rows, for data of any size.

Rows collapse to one per score, and prefix totals over score slices replace a global sort.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradewind.functions.ranking import prefix_totals

METRICS = ("roc_auc", "pr_auc", "accuracy", "positive_rate", "n_rows")


def evaluate(
    scored: DataFrame, label: str, score: str, threshold: float = 0.5, keys: Sequence[str] = ()
) -> DataFrame:
    """One row (per keys): roc_auc, pr_auc, accuracy, positive_rate, n_rows.

    Rows without a label or a score say nothing and are left out.
    Tied scores count as half in the ROC AUC; pr_auc is the step sum of precision over recall.
    Both are NULL when they are undefined for want of a class.
    """
    counts = (
        scored.where(F.col(score).isNotNull() & F.col(label).isNotNull())
        .groupBy(*keys, F.col(score).cast("double").alias("score"))
        .agg(F.sum(F.col(label).cast("bigint")).alias("pos"), F.count(F.lit(1)).alias("n"))
        .select(*keys, "score", "pos", (F.col("n") - F.col("pos")).alias("neg"))
    )
    ranked = prefix_totals(counts, keys, "score", ["pos", "neg"])
    pos, neg = F.col("pos").cast("double"), F.col("neg").cast("double")
    pairs_won = pos * (F.col("neg_below") + neg / 2)
    hits = (F.col("pos_total") - F.col("pos_below")).cast("double")
    false_alarms = (F.col("neg_total") - F.col("neg_below")).cast("double")
    right = F.when(F.col("score") >= threshold, F.col("pos")).otherwise(F.col("neg"))
    positives, negatives = F.sum(pos), F.sum(neg)
    return ranked.groupBy(*keys).agg(
        F.try_divide(F.sum(pairs_won), positives * negatives).alias("roc_auc"),
        F.try_divide(F.sum(pos * hits / (hits + false_alarms)), positives).alias("pr_auc"),
        (F.sum(right) / (positives + negatives)).alias("accuracy"),
        (positives / (positives + negatives)).alias("positive_rate"),
        (F.sum("pos") + F.sum("neg")).alias("n_rows"),
    )
