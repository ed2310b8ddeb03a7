"""Labels and scores chosen by thresholds."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from typing import Any

from pyspark.sql import Column
from pyspark.sql import functions as F

# Labels and cut points that stored tables and dashboards rely on.
RISK_STEPS = ((0.8, "CRITICAL"), (0.6, "HIGH"), (0.4, "MEDIUM"))
BATCH_RISK_STEPS = ((0.8, "CRITICAL"),)
SEVERITY_STEPS = ((0.90, "CRITICAL"), (0.75, "HIGH"))
AMOUNT_LIMITS = (
    (100, "MICRO (<100)"),
    (1000, "SMALL (100-1K)"),
    (10000, "MEDIUM (1K-10K)"),
    (100000, "LARGE (10K-100K)"),
)
VELOCITY_STEPS = ((30, 1.0), (20, 0.9), (15, 0.7), (10, 0.5))
TRAVEL_STEPS = ((100, 0.99), (50, 0.95), (1, 0.85))
HIGH_RISK_CATEGORIES = (
    "CRYPTO_EXCHANGE", "MONEY_TRANSFER", "ONLINE_GAMING", "JEWELRY", "LUXURY_GOODS",
)


def first_match(cases: Sequence[tuple[Column, Any]], otherwise: Any) -> Column:
    """Value of the first true condition. A null condition counts as not met."""
    (condition, value), *rest = cases
    chain = reduce(lambda acc, case: acc.when(*case), rest, F.when(condition, value))
    return chain.otherwise(otherwise)


def at_least(value: Column, steps: Sequence[tuple[float, Any]], otherwise: Any) -> Column:
    return first_match([(value >= bound, label) for bound, label in steps], otherwise)


def above(value: Column, steps: Sequence[tuple[float, Any]], otherwise: Any) -> Column:
    return first_match([(value > bound, label) for bound, label in steps], otherwise)


def below(value: Column, limits: Sequence[tuple[float, Any]], otherwise: Any) -> Column:
    return first_match([(value < bound, label) for bound, label in limits], otherwise)


def risk_band(score: Column) -> Column:
    return at_least(score, RISK_STEPS, "LOW")


def batch_risk_band(score: Column) -> Column:
    return at_least(score, BATCH_RISK_STEPS, "LOW")


def alert_severity(score: Column) -> Column:
    return at_least(score, SEVERITY_STEPS, "MEDIUM")


def amount_band(amount: Column) -> Column:
    return below(amount, AMOUNT_LIMITS, "VERY_LARGE (>100K)")


def velocity_score(txn_count: Column) -> Column:
    return above(txn_count, VELOCITY_STEPS, 0.2)


def travel_score(speed_kmh: Column) -> Column:
    return above(speed_kmh, TRAVEL_STEPS, 0.5)


def is_high_risk_category(category: Column) -> Column:
    return category.isin(*HIGH_RISK_CATEGORIES)
