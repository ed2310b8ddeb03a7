"""Thresholds of the risk rules. Defaults are the values the rules run with in production."""

from __future__ import annotations

from dataclasses import dataclass
from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class RiskParams:
    # None means the wall clock; a string is read in the session time zone.
    as_of: str | None = None
    lookback_days: int = 30
    # Set when the input is laid out by this date column, to skip whole partitions.
    partition_column: str | None = None
    amount_column: str = "amount"

    alert_min_score: float = 0.60

    velocity_min_txns: int = 1
    velocity_window: str = "60 minutes"
    velocity_window_limit: int = 15

    travel_min_speed_kmh: float = 0.1
    travel_min_distance_km: float = 0.1
    # False leaves transactions without a customer out instead of pairing them as if they were one.
    travel_unknown_customers: bool = True

    structuring_low: float = 9000
    structuring_high: float = 9999
    structuring_min_count: int = 3

    high_value_night_amount: float = 10000
    new_merchant_days: int = 90
    merchant_history_weight: Decimal = Decimal("0.4")
    merchant_rate_weight: Decimal = Decimal("0.4")
    merchant_new_weight: Decimal = Decimal("0.2")
    # None keeps an unknown merchant at the ceiling of 1.0 (LEAST ignores nulls).
    missing_merchant_history: float | None = None

    velocity_fraud_types: tuple[str, ...] = ("VELOCITY",)
    micro_fraud_amount: float = 1000
    high_value_fraud_amount: float = 10000
    high_value_fraud_score: float = 0.90

    rolling_days: int = 7
    # False keeps the current day inside its own rolling frame.
    trailing_frame: bool = False
    anomaly_z: float = 3
    critical_z: float = 4

    lag_warning_minutes: int = 30
    lag_critical_minutes: int = 60

    max_null_pct: float = 5.0


def now_like(df: DataFrame, column: str, params: RiskParams) -> Column:
    """`as_of` in the type of `column`, so a comparison leaves the column bare and is pushed down."""
    now = F.lit(params.as_of).cast("timestamp") if params.as_of else F.current_timestamp()
    return now.cast(df.schema[column].dataType)
