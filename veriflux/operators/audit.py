"""Ingestion and audit columns."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from veriflux.functions.hashing import null_safe_hash
from veriflux.functions.times import parse_date, parse_timestamp


def stamp_ingestion(df: DataFrame, source_system: str) -> DataFrame:
    return df.withColumns({
        "_ingested_at": F.current_timestamp(),
        "_ingested_date": F.current_date(),
        "_source_system": F.lit(source_system),
    })


# A time of day with an offset or a zone behind it.
OFFSET = r"\d:\d{2}(:\d{2}([.]\d+)?)?\s*(Z|[+-]\d{1,2}(:?\d{2})?|[A-Z]{2,5}([+-]\d{1,2}(:?\d{2})?)?|[A-Za-z_]+(/[A-Za-z0-9_+-]+)+)$"


def type_event_time(df: DataFrame, source_zone: str | None = None) -> DataFrame:
    """Adds `event_timestamp` and types `transaction_date`; unreadable values become null.

    Times without an offset or zone are read in the session time zone (UTC), or in `source_zone`.
    """
    event_time = parse_timestamp(F.col("timestamp"))
    if source_zone:
        local = F.to_utc_timestamp(event_time, source_zone)
        event_time = F.when(F.col("timestamp").cast("string").rlike(OFFSET), event_time).otherwise(local)
    return df.withColumns({
        "event_timestamp": event_time,
        "transaction_date": parse_date(F.col("transaction_date").cast("string")),
    })


def add_audit_columns(
    df: DataFrame, layer: str, pipeline_name: str, hash_columns: Sequence[str] | None = None
) -> DataFrame:
    """Layer, pipeline, processing time and a hash of the business columns.

    Columns that start with an underscore describe the run, not the record, and stay out of the hash.
    """
    covered = hash_columns or [c for c in df.columns if not c.startswith("_")]
    return df.withColumns({
        "_layer": F.lit(layer),
        "_pipeline_name": F.lit(pipeline_name),
        "_processed_at": F.current_timestamp(),
        "_processed_date": F.current_date(),
        "_record_hash": null_safe_hash(*covered),
    })
