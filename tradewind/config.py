"""Parameters of the build, with the defaults of the published project."""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class Settings:
    late_delivery_grace_days: int = 0
    large_order_threshold: float = 200
    customer_high_value_threshold: float = 500
    customer_medium_value_threshold: float = 150
    seller_late_rate_threshold: float = 20
    seller_min_orders: int = 10
    # Half-open purchase window; it applies only when both bounds are given.
    start_date: str = ""
    end_date: str = ""


@dataclass(frozen=True)
class AnomalySettings:
    """Both values must be given: a missing one is a TypeError, not a silent default."""

    rolling_window_days: int
    anomaly_z_threshold: float


@dataclass(frozen=True)
class TrainingSettings:
    test_frac: float = 0.2
    seed: int = 42
    threshold: float = 0.5
    min_roc_auc: float = 0.61
    max_iter: int = 1000
    inverse_regularization: float = 1.0
