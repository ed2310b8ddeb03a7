"""Time arithmetic."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F


def parse_timestamp(text: Column) -> Column:
    """ISO text to timestamp; unreadable text becomes null instead of stopping the query."""
    return text.try_cast("timestamp")


def parse_date(text: Column) -> Column:
    return text.try_cast("date")


def hours_between(earlier: Column, later: Column) -> Column:
    """Whole seconds over 3600 as a decimal with six places."""
    return (F.unix_timestamp(later) - F.unix_timestamp(earlier)) / F.lit(Decimal("3600.0"))


def minutes_between(earlier: Column, later: Column) -> Column:
    """Full minutes, cut towards zero."""
    return F.timestamp_diff("MINUTE", earlier, later)


def calendar_parts(ts: Column) -> dict[str, Column]:
    """Hour, weekday (Monday = 0), weekend and night flags of a transaction time."""
    hour, day = F.hour(ts), F.weekday(ts)
    return {
        "hour_of_day": hour,
        "day_of_week": day,
        "is_weekend": day >= 5,
        "is_night_transaction": (hour < 5) | (hour >= 23),
    }
