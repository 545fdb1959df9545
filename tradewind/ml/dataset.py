"""Feature contract, reproducible split and fingerprint of the training data."""

from __future__ import annotations

import json
from collections.abc import Mapping
from typing import Any

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradewind.config import TrainingSettings
from tradewind.functions.expressions import HASH_BUCKETS, hash_bucket
from tradewind.sources import sinks

# The key, the features in model order, and the target.
KEY = "order_id"
NUMERIC = (
    "items_cnt",
    "order_value",
    "freight_share",
    "max_installments",
    "customer_seller_distance_km",
    "estimated_delivery_span_days",
    "purchase_month",
    "total_weight_g",
)
CATEGORICAL = ("customer_state", "main_payment_type")
FEATURES = NUMERIC + CATEGORICAL
TARGET = "is_late_delivery"


def feature_frame(features: DataFrame) -> DataFrame:
    """Key, numeric features as doubles, categories, target."""
    return features.select(
        KEY, *[F.col(c).cast("double").alias(c) for c in NUMERIC], *CATEGORICAL, TARGET
    )


def in_holdout(test_frac: float, seed: int, key: str = KEY):
    """Condition for holdout rows: depends on key and seed only, and grows with the fraction."""
    if test_frac <= 0 or test_frac >= 1:
        raise ValueError(f"test_frac is the held-out share, above 0 and below 1; {test_frac} is not")
    return hash_bucket(key, seed) < int(test_frac * HASH_BUCKETS)


def split_by_hash(df: DataFrame, test_frac: float, seed: int) -> tuple[DataFrame, DataFrame]:
    """(train, holdout), the same for any order or partitioning of the rows."""
    held = in_holdout(test_frac, seed)
    return df.where(~held), df.where(held)


def labelled(features: DataFrame) -> DataFrame:
    """Model columns of the orders whose outcome is known."""
    return feature_frame(features).where(F.col(TARGET).isNotNull())


def training_dataset(
    features: DataFrame, settings: TrainingSettings = TrainingSettings()
) -> tuple[DataFrame, DataFrame]:
    return split_by_hash(labelled(features), settings.test_frac, settings.seed)


def training_metadata(features: DataFrame, settings: TrainingSettings = TrainingSettings()) -> DataFrame:
    """One row: rows_train, rows_holdout, positive_rate (4 digits), features."""
    held = in_holdout(settings.test_frac, settings.seed)
    return (
        labelled(features)
        .select(TARGET, held.alias("held"))
        .agg(
            F.count_if(~F.col("held")).alias("rows_train"),
            F.count_if(F.col("held")).alias("rows_holdout"),
            F.round(F.avg(F.col(TARGET).cast("int")), 4).alias("positive_rate"),
        )
        .withColumn("features", F.lit(json.dumps(list(FEATURES))))
    )


def write_training_dataset(train: DataFrame, holdout: DataFrame, folder: str) -> dict[str, str]:
    """Hand-off between jobs: one parquet folder per part."""
    return {
        name: sinks.write_table(df, folder, "ml", name) for name, df in (("train", train), ("holdout", holdout))
    }


def dataset_fingerprint(df: DataFrame, params: Mapping[str, Any]) -> DataFrame:
    """One row with a hash of the keys and the parameters, independent of row order.

    It hashes the row count and the sum of the first 60 hash bits of every key, which partial
    aggregation adds up anywhere; joining all sorted keys into one string would need one task.
    """
    bits = F.conv(F.substring(F.md5(F.col(KEY).cast("string")), 1, 15), 16, 10).cast("decimal(28,0)")
    text = json.dumps(dict(params), sort_keys=True, default=str)
    return df.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum(bits), F.lit(0)).alias("total")).select(
        F.md5(
            F.concat_ws("|", F.col("n").cast("string"), F.col("total").cast("string"), F.lit("#" + text))
        ).alias("fingerprint")
    )
