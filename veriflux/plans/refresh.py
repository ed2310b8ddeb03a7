"""One full refresh of the silver and gold tables, in dependency order.

Every dataset that several others read is stored first, so that change data is merged once and the gold
queries start from Parquet that is laid out by day.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import replace

from pyspark.sql import DataFrame

from veriflux.operators import quality
from veriflux.operators.cdc import current_versions
from veriflux.operators.ordered import SkewPolicy
from veriflux.params import RiskParams
from veriflux.plans import gold, monitoring, silver
from veriflux.sinks.files import create_layers, save_table


def name_views(datasets: dict[str, DataFrame], prefix: str = "") -> list[str]:
    """Makes datasets known to SQL in this session; the names of the views."""
    for name, rows in datasets.items():
        rows.createOrReplaceTempView(f"{prefix}{name}")
    return [f"{prefix}{name}" for name in datasets]


def refresh_silver(
    live_changes: DataFrame,
    landed: DataFrame,
    merchant_changes: DataFrame,
    customer_changes: DataFrame,
    fx: DataFrame,
    params: RiskParams = RiskParams(),
    transaction_sequence: Sequence[str] = ("_kafka_offset",),
    dimension_sequence: Sequence[str] = ("_ingested_at",),
    policy: SkewPolicy = SkewPolicy(),
    view_prefix: str = "",
) -> dict[str, DataFrame]:
    """Bronze datasets in, stored silver tables out.

    Transactions without an id (malformed messages among them) have no key: they are stored in `silver.quarantine`
    before deduplication and change data would merge them into one. The two data sets without a copy of their own can
    be queried as the views `transactions_enriched` and `transactions_unified`. Views belong to the session: refreshes that share one
    tell theirs apart by `view_prefix`.
    """
    create_layers(live_changes.sparkSession)
    day = ["transaction_date"]
    quarantine = silver.unkeyed(live_changes).unionByName(silver.unkeyed(landed), allowMissingColumns=True)
    quarantine = save_table(quarantine, "silver.quarantine")
    cleaned = save_table(
        silver.transactions_cleaned(live_changes, transaction_sequence, quarantine=True), "silver.transactions_cleaned", day)
    landed_cleaned = save_table(
        silver.transactions_landed_cleaned(landed, params.as_of, quarantine=True), "silver.transactions_landed_cleaned", day)
    rates = save_table(silver.exchange_rates(fx), "silver.exchange_rates")
    enriched = silver.transactions_enriched(cleaned, rates)
    # A union of two stored tables needs no copy of its own; filters reach both scans.
    unified = silver.transactions_unified(cleaned, landed_cleaned)
    name_views({"transactions_enriched": enriched, "transactions_unified": unified}, view_prefix)
    return {
        "quarantine": quarantine,
        # Tracked, not enforced: the live path keeps every transaction.
        "quality": save_table(quality.report(cleaned, quality.silver_rules(params.as_of)), "silver.quality"),
        "transactions_cleaned": cleaned,
        "transactions_landed_cleaned": landed_cleaned,
        "exchange_rates": rates,
        "transactions_enriched": enriched,
        "transactions_unified": unified,
        "merchants": save_table(
            silver.merchants_current(merchant_changes, dimension_sequence), "silver.merchants"),
        "customers": save_table(
            silver.customers_history(customer_changes, dimension_sequence, policy), "silver.customers"),
    }


def refresh_gold(
    tables: dict[str, DataFrame],
    params: RiskParams = RiskParams(),
    policy: SkewPolicy = SkewPolicy(),
    enforce_rules: bool = True,
    bronze: DataFrame | None = None,
) -> dict[str, DataFrame]:
    """Silver tables in, stored gold tables out. With `enforce_rules` a bad profile stops the refresh. With the live `bronze`
    transactions, the health of the three layers is stored too."""
    pruned = replace(params, partition_column="transaction_date")
    unified = tables["transactions_unified"]
    alerts = save_table(gold.fraud_alerts(tables["transactions_cleaned"], params), "gold.fraud_alerts")
    profiles = gold.customer_profiles(unified, current_versions(tables["customers"]), pruned)
    if enforce_rules:
        profiles = quality.fail_on_violation(profiles, quality.gold_rules())
    views = {
        "velocity": gold.velocity(unified, pruned),
        "impossible_travel": gold.impossible_travel(unified, pruned, policy),
        "merchant_scores": gold.merchant_scores(unified, tables["merchants"], pruned),
        "customer_profiles": profiles,
        "aml_structuring": gold.aml_structuring(unified, params),
        "daily_anomalies": monitoring.daily_anomalies(unified, params),
        "ops_kpis": gold.ops_kpis(unified),
        "fraud_clusters": gold.fraud_clusters(alerts, params),
        "fraud_hotspots": gold.fraud_hotspots(alerts),
        "fraud_type_mix": gold.fraud_type_mix(alerts),
    }
    if bronze is not None:
        views["pipeline_health"] = monitoring.pipeline_health(bronze, tables["transactions_cleaned"], alerts, params)
    return {"fraud_alerts": alerts, **{name: save_table(view, f"gold.{name}") for name, view in views.items()}}
