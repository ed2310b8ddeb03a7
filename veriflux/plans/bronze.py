"""Raw datasets. Each takes a batch or streaming scan and keeps what its rules allow."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from veriflux.operators import quality
from veriflux.operators.audit import add_audit_columns, stamp_ingestion, type_event_time
from veriflux.sources.bus import unpack

# How stored rows name their pipeline and origin.
PIPELINE = "fraud_engine_v1"
LIVE, LANDED, CUSTOMERS, MERCHANTS, FX = "KAFKA", "S3_AUTO_LOADER", "S3_CUSTOMERS", "S3_MERCHANTS", "S3_FX_RATES"
WATERMARK = "30 minutes"


def _late_bound(df: DataFrame) -> DataFrame:
    return df.withWatermark("event_timestamp", WATERMARK) if df.isStreaming else df


def _tracked(df: DataFrame, rules: quality.Rules, name: str) -> DataFrame:
    """Counts violations in the progress of a stream. For batch frames there is `quality.report`, which
    does not stand in the way of filters and column pruning."""
    return quality.track_stream(df, rules, name) if df.isStreaming else df


def transactions_raw(envelopes: DataFrame, source_zone: str | None = None) -> DataFrame:
    """Live messages, all kept; malformed bodies carry their text in the corrupt-record column."""
    rows = type_event_time(stamp_ingestion(unpack(envelopes), LIVE), source_zone)
    tracked = _tracked(_late_bound(rows), quality.BRONZE_RULES, "bronze_transactions_raw")
    return add_audit_columns(tracked, "BRONZE", PIPELINE)


def transactions_landed(scan: DataFrame, source_zone: str | None = None) -> DataFrame:
    """Historical transactions from landing files."""
    rows = type_event_time(stamp_ingestion(scan, LANDED), source_zone)
    tracked = _tracked(_late_bound(rows), quality.BRONZE_RULES, "bronze_transactions_landed")
    return add_audit_columns(tracked, "BRONZE", PIPELINE)


def customers(scan: DataFrame) -> DataFrame:
    kept = quality.drop_violations(scan, quality.CUSTOMER_DROP_RULES)
    kept = _tracked(kept, quality.CUSTOMER_TRACK_RULES, "bronze_customers")
    rows = stamp_ingestion(kept, CUSTOMERS).withColumn("_batch_id", F.lit(None).cast("string"))
    return add_audit_columns(rows, "BRONZE", PIPELINE)


def merchants(scan: DataFrame) -> DataFrame:
    kept = quality.drop_violations(scan, quality.MERCHANT_DROP_RULES)
    return add_audit_columns(stamp_ingestion(kept, MERCHANTS), "BRONZE", PIPELINE)


def fx_rates(scan: DataFrame) -> DataFrame:
    kept = quality.drop_violations(scan, quality.FX_DROP_RULES)
    return add_audit_columns(stamp_ingestion(kept, FX), "BRONZE", PIPELINE)


def dead_letter(rows: DataFrame, malformed: Column | None = None) -> DataFrame:
    """Quarantined transactions with the first reason that applies."""
    _, rejected = quality.split(rows, malformed)
    return add_audit_columns(rejected, "BRONZE", PIPELINE)
