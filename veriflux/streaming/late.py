"""Rows behind the watermark, which Spark's windows and deduplication drop without a trace but a number."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, StructField, StructType

from veriflux.streaming.keyed import Lateness, as_micros, as_times
from veriflux.streaming.run import watermarked


def mark_late(rows: DataFrame, time_column: str, spread_by: str, lateness: str, tasks: int | None = None) -> DataFrame:
    """All rows of a stream with `_late`: whether the row's time lies behind the watermark of its micro-batch, by the rule
    by which stateful operators drop rows. Rows without a time are not late.

    Rows are dealt to as many groups as there are shuffle partitions (or `tasks`), by a hash of `spread_by` and the time, so that no key is
    hot; nothing is kept between micro-batches. Columns are of simple types."""
    tasks = tasks or int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    given = StructType([StructField(f.name, f.dataType) for f in rows.schema.fields])
    plain = as_micros(watermarked(rows, time_column, lateness, "_at")).drop("_at")
    dealt = plain.withColumn("_group", F.pmod(F.xxhash64(spread_by, time_column), F.lit(tasks)))
    columns = StructType([StructField(f.name, f.dataType) for f in plain.schema.fields])
    found = dealt.groupBy("_group").transformWithState(
        Lateness(columns, time_column), StructType([*columns.fields, StructField("_late", BooleanType())]), "append", "eventTime")
    return as_times(found, given)
