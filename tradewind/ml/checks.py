"""Checks of the training data and of the model."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradewind.ml.dataset import FEATURES, NUMERIC, TARGET
from tradewind.ml.metrics import evaluate

# Columns known only after the order was placed, and the default gate.
LEAKY = (TARGET, "delivery_delay_days", "order_delivered_customer_date", "review_score")
MIN_ROC_AUC = 0.61
# A single feature that ranks the target this well is the target in disguise.
LEAK_AUC = 0.99


def gate(value: float, threshold: float) -> bool:
    """The boundary passes."""
    return value >= threshold


def quality_gate(metrics: DataFrame, min_roc_auc: float = MIN_ROC_AUC) -> DataFrame:
    """Blocking check of severity error on the ROC AUC of one metrics row; an undefined AUC fails."""
    return metrics.select(
        F.lit("quality_gate").alias("check_name"),
        F.round("roc_auc", 4).alias("roc_auc_holdout"),
        F.lit(min_roc_auc).alias("threshold"),
        F.coalesce(F.col("roc_auc") >= min_roc_auc, F.lit(False)).alias("passed"),
        F.lit("error").alias("severity"),
        F.lit(True).alias("blocking"),
    )


def leaked_names(features: tuple[str, ...] = FEATURES) -> list[str]:
    """Features that are only known after the order was placed."""
    return [name for name in LEAKY if name in features]


def no_leakage(data: DataFrame, features: tuple[str, ...] = NUMERIC) -> DataFrame:
    """One row per numeric feature: its own ROC AUC, whether its name is forbidden, and the verdict.

    All features are measured in one job, with the feature name as the grouping key.
    """
    long = data.select(
        F.col(TARGET).alias("label"), *[F.col(c).cast("double").alias(c) for c in features]
    ).unpivot(["label"], list(features), "feature", "value")
    forbidden = F.col("feature").isin(*LEAKY)
    suspicious = (F.col("roc_auc") >= LEAK_AUC) | (F.col("roc_auc") <= 1 - LEAK_AUC)
    return evaluate(long, "label", "value", keys=["feature"]).select(
        "feature",
        "roc_auc",
        forbidden.alias("forbidden_name"),
        (~forbidden & ~F.coalesce(suspicious, F.lit(False))).alias("passed"),
    )
