"""Result shape shared with the SQL side: naive times, dates as text, doubles for decimals."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (
    ArrayType, ByteType, DataType, DateType, DecimalType, IntegerType, ShortType, TimestampType,
)

# Run-time stamps have no counterpart in the SQL.
STAMPS = ("computed_at", "detected_at", "alert_generated_at")


def _plain(name: str, kind: DataType) -> Column:
    column = F.col(name)
    if isinstance(kind, DateType):
        return column.cast("string")
    if isinstance(kind, TimestampType):
        return column.cast("timestamp_ntz")
    if isinstance(kind, DecimalType):
        return column.cast("double")
    if isinstance(kind, (IntegerType, ShortType, ByteType)):
        return column.cast("bigint")
    if isinstance(kind, ArrayType):
        return F.array_join(column, ",", "-")
    return column


def present(
    df: DataFrame, digits: Mapping[str, int] | None = None, drop: Sequence[str] = STAMPS
) -> DataFrame:
    """`digits` rounds the columns whose last bits depend on the order of evaluation."""
    digits = digits or {}
    return df.select(*[
        (F.round(_plain(f.name, f.dataType), digits[f.name]) if f.name in digits
         else _plain(f.name, f.dataType)).alias(f.name)
        for f in df.schema.fields if f.name not in drop
    ])
