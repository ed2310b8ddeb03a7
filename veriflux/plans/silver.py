"""Cleaned datasets."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from veriflux.functions import bands
from veriflux.operators import quality
from veriflux.operators.audit import add_audit_columns
from veriflux.operators.cdc import drop_duplicates, scd1, scd2
from veriflux.operators.ordered import SkewPolicy
from veriflux.operators.sizing import MAX_BROADCAST_ROWS, fits_broadcast, lookup_left
from veriflux.plans.bronze import PIPELINE

# What the current table leaves behind, and what makes a new customer version.
TRANSPORT_COLUMNS = (
    "_kafka_topic", "_kafka_partition", "_kafka_offset", "_kafka_timestamp", "_kafka_produced_at",
    "_schema_version", "timestamp", "_ingested_at", "_ingested_date", "_pipeline_name",
)
CUSTOMER_HISTORY = (
    "kyc_status", "account_status", "risk_score", "city", "state", "income_band", "is_politically_exposed",
)


def unkeyed(rows: DataFrame) -> DataFrame:
    """Transactions without an id, malformed messages among them: they have no key, and merging or deduplicating by it would
    make one row of them all."""
    return rows.filter(F.col("transaction_id").isNull())


def _keyed(rows: DataFrame, quarantine: bool) -> DataFrame:
    return rows.filter(F.col("transaction_id").isNotNull()) if quarantine else rows


def transactions_cleaned(
    changes: DataFrame, sequence: Sequence[str] = ("_kafka_offset",), unique_sequence: bool = False, quarantine: bool = False
) -> DataFrame:
    """Current row per transaction, of a batch frame.

    The messages of a customer share a topic partition, so an offset occurs once per transaction unless the topic was
    partitioned anew (see `topic_epochs`). `unique_sequence` promises that; otherwise ties go by the record hash. With
    `quarantine`, rows that `unkeyed` lists are left out.
    """
    dropped = [c for c in (*TRANSPORT_COLUMNS, *sequence) if c in changes.columns]
    return scd1(_keyed(changes, quarantine), ["transaction_id"], sequence, exclude=dropped, unique_sequence=unique_sequence)


def first_epoch(changes: DataFrame, partition: str = "_kafka_partition") -> DataFrame:
    """Marks (topic_partition, first_offset, epoch) for partitions that were never dealt anew."""
    return changes.select(F.col(partition).alias("topic_partition")).distinct().select("topic_partition", F.lit(0).cast("bigint").alias("first_offset"), F.lit(0).alias("epoch"))


def next_epoch(
    marks: DataFrame, changes: DataFrame, fresh: Sequence[int] = (), partition: str = "_kafka_partition", offset: str = "_kafka_offset"
) -> DataFrame:
    """Marks after the topic was partitioned anew: whatever a partition holds beyond its high-water mark, and all of the
    `fresh` partitions, belongs to a later epoch. `changes` holds the messages up to then."""
    spark = marks.sparkSession
    high = changes.groupBy(F.col(partition).alias("topic_partition")).agg((F.max(offset) + 1).cast("bigint").alias("first_offset"))
    new = spark.createDataFrame([(int(p), 0) for p in fresh], "topic_partition int, first_offset bigint")
    later = marks.agg(F.max("epoch")).first()[0] + 1
    return marks.unionByName(high.unionByName(new).withColumn("epoch", F.lit(later)))


def topic_epochs(changes: DataFrame, marks: DataFrame, partition: str = "_kafka_partition", offset: str = "_kafka_offset") -> DataFrame:
    """Adds `_epoch`, so that (`_epoch`, offset) orders the messages of a key also across partitions: the last mark of the
    message's partition at or before its offset. Marks are one row per partition and epoch."""
    lists = marks.groupBy("topic_partition").agg(F.sort_array(F.collect_list(F.struct("first_offset", "epoch"))).alias("_marks"))
    side = F.broadcast(lists) if fits_broadcast(lists) else lists
    rows = changes.join(side, F.col(partition) == F.col("topic_partition"), "left")
    reached = F.filter("_marks", lambda m: m["first_offset"] <= F.col(offset))
    return rows.withColumn("_epoch", F.coalesce(F.get(F.reverse(reached), F.lit(0))["epoch"], F.lit(0))).drop("_marks", "topic_partition")


def merchants_current(changes: DataFrame, sequence: Sequence[str] = ("_ingested_at",)) -> DataFrame:
    return scd1(changes, ["merchant_id"], sequence)


def customers_history(
    changes: DataFrame, sequence: Sequence[str] = ("_ingested_at",), policy: SkewPolicy = SkewPolicy()
) -> DataFrame:
    return scd2(changes, ["customer_id"], sequence, CUSTOMER_HISTORY, policy)


def exchange_rates(fx: DataFrame, ingested: str = "_ingested_at") -> DataFrame:
    """One rate per currency and date: the one ingested last. Null rates say nothing; of rates that were ingested
    together the largest counts, so that the order of rows doesn't matter."""
    order = F.when(F.col("usd_multiplier").isNotNull(), F.struct(ingested, "usd_multiplier"))
    return fx.groupBy("currency_code", "rate_date").agg(F.max_by("usd_multiplier", order).alias("usd_multiplier"))


def with_usd_amount(
    transactions: DataFrame, rates: DataFrame, max_broadcast_rows: int = MAX_BROADCAST_ROWS, rows_per_task: int = 2_000_000
) -> DataFrame:
    """Adds `amount_usd`; without a rate the amount stays as it is. `transactions` may be a stream: its rates are those
    known at the start, see `streaming.rates` for rates that arrive meanwhile."""
    priced = lookup_left(
        transactions,
        rates.select("currency_code", "rate_date", "usd_multiplier"),
        on=[("currency", "currency_code"), ("transaction_date", "rate_date")],
        spread_by="transaction_id",
        max_rows=max_broadcast_rows,
        rows_per_task=rows_per_task,
    )
    converted = F.coalesce(F.col("amount") * F.col("usd_multiplier"), F.col("amount"))
    return priced.withColumn("amount_usd", converted).drop("usd_multiplier")


def transactions_enriched(
    transactions: DataFrame, rates: DataFrame, max_broadcast_rows: int = MAX_BROADCAST_ROWS
) -> DataFrame:
    """USD amount, risk and amount bands and the high-risk merchant flag."""
    rows = with_usd_amount(transactions, rates, max_broadcast_rows).withColumns({
        "risk_band": bands.risk_band(F.col("fraud_score")),
        "amount_band": bands.amount_band(F.col("amount_usd")),
        "is_high_risk_merchant": bands.is_high_risk_category(F.col("merchant_category")),
        "_silver_processed_at": F.current_timestamp(),
    })
    return add_audit_columns(rows, "SILVER", PIPELINE)


def transactions_landed_cleaned(
    landed: DataFrame, as_of: str | None = None, first_by: Sequence[str] = (), quarantine: bool = False
) -> DataFrame:
    """Historical transactions without duplicates and without rows that break a rule. With `quarantine`, batch and stream
    leave out what `unkeyed` lists; otherwise one row without an id stands for all of them."""
    unique = drop_duplicates(_keyed(landed, quarantine), ["transaction_id"], watermark=True, first_by=first_by)
    rows = unique.withColumns({
        "amount_usd": F.col("amount"),
        "risk_band": bands.batch_risk_band(F.col("fraud_score")),
        "_processing_path": F.lit("S3_BATCH"),
    })
    return add_audit_columns(quality.drop_violations(rows, quality.silver_rules(as_of)), "SILVER", PIPELINE)


def transactions_unified(live: DataFrame, landed: DataFrame, dedup_keys: Sequence[str] = ()) -> DataFrame:
    """Live and historical rows under one schema. A transaction in both counts twice unless deduplicated."""
    both = live.unionByName(landed, allowMissingColumns=True)
    return drop_duplicates(both, dedup_keys) if dedup_keys else both
