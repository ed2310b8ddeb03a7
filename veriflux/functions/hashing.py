"""Row fingerprints."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def plain_hash(*columns: str) -> Column:
    """xxhash64 as it is: nulls are skipped, so (null, 'a') equals ('a', null)."""
    return F.xxhash64(*columns)


def null_safe_hash(*columns: str) -> Column:
    """xxhash64 that also sees where the nulls are."""
    return F.xxhash64(*[part for c in columns for part in (F.col(c), F.col(c).isNull())])
