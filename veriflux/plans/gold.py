"""Fraud views over unified transactions."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from veriflux.functions import bands
from veriflux.functions.geo import haversine_km
from veriflux.functions.hashing import null_safe_hash
from veriflux.functions.times import hours_between, minutes_between
from veriflux.operators import quality
from veriflux.operators.ordered import OrderedRows, SkewPolicy
from veriflux.params import RiskParams, now_like


def recent(transactions: DataFrame, params: RiskParams = RiskParams()) -> DataFrame:
    """The look-back period. With a partition column, whole partitions before it are never listed."""
    since = now_like(transactions, "event_timestamp", params) - F.expr(f"INTERVAL {params.lookback_days} DAYS")
    rows = transactions.filter(F.col("event_timestamp") >= since)
    if params.partition_column:
        rows = rows.filter(F.col(params.partition_column) >= since.cast("date"))
    return rows


def _when_sum(condition: Column, value: Column) -> Column:
    return F.sum(F.when(condition, value).otherwise(F.lit(0)))


def _rate(part: Column, whole: Column) -> Column:
    """Decimal share of two counts; null when there is nothing to divide by."""
    return part * F.lit(Decimal("1.0")) / F.nullif(whole, F.lit(0))


# ---- alerts -------------------------------------------------------------------------------------

ALERT_COLUMNS = (
    "alert_id", "transaction_id", "customer_id", "merchant_id", "amount", "currency", "event_timestamp",
    "fraud_type", "fraud_score", "alert_severity", "location_city", "location_country", "payment_method",
    "device_id", "alert_message", "alert_generated_at",
)


def fraud_alerts(transactions: DataFrame, params: RiskParams = RiskParams()) -> DataFrame:
    """One alert per confirmed, high-scoring transaction; stateless, so it runs on streams as is."""
    score = F.col("fraud_score")
    message = F.concat_ws(
        " | ",
        F.lit("FRAUD ALERT"),
        F.col("fraud_type"),
        F.concat(F.lit("Score:"), score.cast("string")),
        F.concat(F.lit("Amount:₹"), F.col("amount").cast("string")),
        F.col("customer_id"),
        F.col("location_city"),
    )
    suspicious = transactions.filter(F.col("is_fraud") & (score >= params.alert_min_score))
    checked = quality.fail_on_violation(suspicious, quality.ALERT_FAIL_RULES)
    return checked.withColumns({
        "alert_id": F.concat(F.lit("ALERT_"), F.col("transaction_id")),
        "alert_severity": bands.alert_severity(score),
        "alert_message": message,
        "alert_generated_at": F.current_timestamp(),
    }).select(*ALERT_COLUMNS)


# ---- velocity -----------------------------------------------------------------------------------


def velocity(
    transactions: DataFrame,
    params: RiskParams = RiskParams(),
    unit: str = "hour",
    key: str = "customer_id",
) -> DataFrame:
    """Activity per key and clock unit, with score and reasons.

    Several exact distinct counts make Spark group first by key and counted value, so the rows of a hot
    key are spread over its values before the final, already small, merge per key.
    """
    time = F.col("event_timestamp")
    bucket = F.date_trunc(unit, time).cast(transactions.schema["event_timestamp"].dataType)
    counts = (
        recent(transactions, params)
        .filter(F.col("transaction_status") != "FAILED")
        .groupBy(F.col(key), bucket.alias("hour_window"))
        .agg(
            F.count(F.lit(1)).alias("txn_count"),
            F.sum(params.amount_column).alias("total_amount"),
            F.countDistinct("merchant_id").alias("unique_merchants"),
            F.countDistinct("device_id").alias("unique_devices"),
            F.countDistinct("location_city").alias("unique_cities"),
            F.min(time).alias("first_txn_time"),
            F.max(time).alias("last_txn_time"),
            F.avg("fraud_score").alias("avg_fraud_score"),
        )
        .filter(F.col("txn_count") >= params.velocity_min_txns)
    )
    n, devices, cities = F.col("txn_count"), F.col("unique_devices"), F.col("unique_cities")
    reasons = F.array(
        F.when(n > params.velocity_min_txns, F.concat(F.lit("HIGH_VELOCITY:"), n.cast("string"), F.lit("_txns"))),
        F.when(devices > 2, F.concat(F.lit("MULTI_DEVICE:"), devices.cast("string"))),
        F.when(cities > 2, F.lit("MULTI_CITY_VELOCITY")),
    )
    return counts.select(
        key, "hour_window", "txn_count", "total_amount", "unique_merchants", "unique_devices", "unique_cities",
        "first_txn_time", "last_txn_time",
        minutes_between(F.col("first_txn_time"), F.col("last_txn_time")).alias("window_duration_minutes"),
        "avg_fraud_score",
        bands.velocity_score(n).alias("velocity_score"),
        reasons.alias("risk_factors"),
        F.current_timestamp().alias("computed_at"),
    )


def velocity_windows(transactions: DataFrame, params: RiskParams = RiskParams()) -> DataFrame:
    """Customers above the limit in a tumbling window."""
    return (
        transactions.groupBy("customer_id", F.window("event_timestamp", params.velocity_window))
        .agg(F.count(F.lit(1)).alias("txn_count"))
        .filter(F.col("txn_count") > params.velocity_window_limit)
        .select("customer_id", F.col("window.start").alias("window_start"),
                F.col("window.end").alias("window_end"), "txn_count")
    )


# ---- impossible travel --------------------------------------------------------------------------

TRAVEL_STATE = (
    "event_timestamp", "latitude", "longitude", "location_city", "location_country", "transaction_id",
)
TRAVEL_ORDER = ("event_timestamp", "transaction_id", "_tie")


def pairable(transactions: DataFrame, params: RiskParams = RiskParams()) -> DataFrame:
    """What a pair shows of a transaction, with a hash of it that decides between equal times and ids."""
    rows = transactions.select("customer_id", "amount", *TRAVEL_STATE)
    if not params.travel_unknown_customers:
        rows = rows.filter(F.col("customer_id").isNotNull())
    return rows.withColumn("_tie", null_safe_hash("amount", *TRAVEL_STATE))


def with_previous(
    transactions: DataFrame, policy: SkewPolicy = SkewPolicy(), merge_copies: bool = False
) -> DataFrame:
    """Each transaction beside the one before it of the same customer. Ties go by transaction id, then by the
    hash `_tie` where there is one."""
    order = [c for c in TRAVEL_ORDER if c in transactions.columns]
    rows = OrderedRows(transactions, ["customer_id"], order, policy, merge_copies=merge_copies)
    return rows.previous(TRAVEL_STATE).result()


def measured(pairs: DataFrame) -> DataFrame:
    """Distance and time between consecutive transactions (columns as made by `with_previous`)."""
    distance = haversine_km(F.col("prev_latitude"), F.col("prev_longitude"), F.col("latitude"), F.col("longitude"))
    return pairs.withColumns({
        "_km": distance, "_hours": hours_between(F.col("prev_event_timestamp"), F.col("event_timestamp")),
    })


def is_travel(params: RiskParams) -> Column:
    known = F.col("prev_event_timestamp").isNotNull() & F.col("prev_latitude").isNotNull()
    speed = F.col("_km") / F.nullif(F.col("_hours"), F.lit(0))
    return known & (F.col("_km") > params.travel_min_distance_km) & (speed > params.travel_min_speed_kmh)


def score_travel(pairs: DataFrame, params: RiskParams = RiskParams(), detected_at: Column | None = None) -> DataFrame:
    """Speed implied by consecutive transactions (columns as made by `with_previous`)."""
    distance, gap = F.col("_km"), F.col("_hours")
    speed = distance / F.nullif(gap, F.lit(0))
    known = pairs.filter(F.col("prev_event_timestamp").isNotNull() & F.col("prev_latitude").isNotNull())
    return measured(known).filter(is_travel(params)).select(
        "customer_id",
        F.col("transaction_id").alias("txn_id_2"),
        F.col("prev_transaction_id").alias("txn_id_1"),
        F.col("prev_location_city").alias("from_city"),
        F.col("location_city").alias("to_city"),
        F.col("prev_location_country").alias("from_country"),
        F.col("location_country").alias("to_country"),
        F.round(distance, 2).alias("distance_km"),
        F.round(gap, 4).alias("time_gap_hours"),
        F.round(speed, 0).alias("implied_speed_kmh"),
        "amount", "event_timestamp",
        (F.current_timestamp() if detected_at is None else detected_at).alias("detected_at"),
        F.lit("IMPOSSIBLE_TRAVEL").alias("fraud_pattern"),
        bands.travel_score(speed).alias("impossible_travel_score"),
    )


def impossible_travel(
    transactions: DataFrame, params: RiskParams = RiskParams(), policy: SkewPolicy = SkewPolicy()
) -> DataFrame:
    needed = pairable(recent(transactions, params), params)
    # A copy follows its original in no time, which gives no speed: it is never listed itself.
    return score_travel(with_previous(needed, policy, merge_copies=True), params)


# ---- merchants ----------------------------------------------------------------------------------


def merchant_scores(
    transactions: DataFrame, merchants: DataFrame, params: RiskParams = RiskParams()
) -> DataFrame:
    """Risk score and tier per merchant.

    The facts are reduced to one row per merchant before they meet the dimension, which is unique per
    merchant; the join therefore never sees a skewed key.
    """
    amount, fraud = F.col(params.amount_column), F.col("is_fraud")
    one = F.lit(1)
    facts = recent(transactions, params).groupBy("merchant_id").agg(
        F.count(one).alias("total_transactions"),
        F.countDistinct("customer_id").alias("unique_customers"),
        F.sum(amount).alias("total_volume_inr"),
        F.avg(amount).alias("avg_transaction_amount"),
        F.count_if(fraud).alias("fraud_count"),
        _when_sum(fraud, amount).alias("fraud_amount_inr"),
        F.avg("fraud_score").alias("avg_fraud_score"),
        F.max("fraud_score").alias("max_fraud_score"),
        F.countDistinct("fraud_type").alias("distinct_fraud_types"),
        F.count_if(F.col("is_night_transaction") & (amount > params.high_value_night_amount))
        .alias("high_value_night_txns"),
        F.count_if(F.col("failed_attempt_count") > 0).alias("transactions_with_failures"),
    )
    known = merchants.select(
        F.col("merchant_id").alias("_merchant"), "merchant_name", "merchant_category", "risk_category",
        "city", "state", "historical_fraud_score", "merchant_tenure_days",
    )
    history = F.col("historical_fraud_score")
    if params.missing_merchant_history is not None:
        history = F.coalesce(history, F.lit(params.missing_merchant_history))
    frauds, total = F.col("fraud_count"), F.col("total_transactions")
    rate = _rate(frauds, total)
    newcomer = F.when(F.col("merchant_tenure_days") < params.new_merchant_days,
                      F.lit(params.merchant_new_weight)).otherwise(F.lit(Decimal("0.0")))
    score = history * F.lit(params.merchant_history_weight) + rate * F.lit(params.merchant_rate_weight) + newcomer
    tier = bands.first_match(
        [
            ((history > 0.7) | (rate > Decimal("0.15")), "CRITICAL"),
            ((history > 0.4) | (rate > Decimal("0.08")), "HIGH"),
            (history > 0.2, "MEDIUM"),
        ],
        "LOW",
    )
    joined = facts.join(known, facts["merchant_id"] == known["_merchant"], "left")
    return joined.select(
        "merchant_id", "merchant_name", "merchant_category", "risk_category", "city", "state",
        "total_transactions", "unique_customers", "total_volume_inr", "avg_transaction_amount",
        "fraud_count", "fraud_amount_inr",
        F.round(frauds * F.lit(Decimal("100.0")) / F.nullif(total, F.lit(0)), 4).alias("fraud_rate_pct"),
        "avg_fraud_score", "max_fraud_score", "distinct_fraud_types", "high_value_night_txns",
        "transactions_with_failures",
        F.round(F.least(F.lit(1.0), score), 4).alias("computed_risk_score"),
        tier.alias("merchant_risk_tier"),
        F.current_timestamp().alias("computed_at"),
    )


def top_merchants(scores: DataFrame, k: int) -> DataFrame:
    """The k riskiest merchants; ties go by merchant id."""
    return scores.orderBy(F.desc("computed_risk_score"), F.asc("merchant_id")).limit(k)


# ---- customers ----------------------------------------------------------------------------------


def customer_stats(transactions: DataFrame, params: RiskParams = RiskParams()) -> DataFrame:
    """Thirty-day behaviour per customer.

    Distinct values are counted beside the sums: an aggregate that does both keeps all sums again for each distinct value
    of a customer.
    """
    amount, fraud, one = F.col(params.amount_column), F.col("is_fraud"), F.lit(1)
    rows = recent(transactions, params)
    distinct = {
        "unique_devices_30d": "device_id", "unique_cities_30d": "location_city",
        "unique_merchant_cats": "merchant_category", "unique_ips_30d": "ip_address",
    }
    sums = rows.groupBy("customer_id").agg(
        F.count(one).alias("total_txns_30d"),
        F.sum(amount).alias("total_spend_30d"),
        F.avg(amount).alias("avg_txn_amount"),
        F.max(amount).alias("max_single_txn"),
        F.stddev_samp(amount).alias("txn_amount_stddev"),
        *[F.lit(0).cast("bigint").alias(name) for name in distinct],
        F.avg("hour_of_day").alias("avg_hour_of_day"),
        F.count_if(F.col("is_night_transaction")).alias("night_txn_count"),
        F.count_if(F.col("is_weekend")).alias("weekend_txn_count"),
        F.sum("failed_attempt_count").alias("total_failures"),
        F.avg("failed_attempt_count").alias("avg_failures_per_txn"),
        F.count_if(fraud).alias("confirmed_fraud_count"),
        _when_sum(fraud, amount).alias("confirmed_fraud_amount"),
        F.avg("fraud_score").alias("avg_fraud_score"),
        F.max("fraud_score").alias("max_fraud_score"),
        F.count_if(F.col("is_foreign_transaction")).alias("foreign_txn_count"),
        F.count_if(amount.between(params.structuring_low, params.structuring_high))
        .alias("structuring_pattern_count"),
    )
    values = F.array(*[F.struct(F.lit(name).alias("name"), F.col(c).cast("string").alias("value")) for name, c in distinct.items()])
    seen = rows.select("customer_id", F.inline(values)).filter(F.col("value").isNotNull()).distinct()
    counts = seen.groupBy("customer_id").agg(*[F.count_if(F.col("name") == name).alias(name) for name in distinct])
    # One row of either kind for each customer: nulls are left out of the greatest value.
    both = sums.unionByName(counts, allowMissingColumns=True)
    return both.groupBy("customer_id").agg(*[F.max(c).alias(c) for c in sums.columns if c != "customer_id"])


def customer_profiles(
    transactions: DataFrame, current_customers: DataFrame, params: RiskParams = RiskParams()
) -> DataFrame:
    """Behaviour beside the current customer record, with score and tier.

    `current_customers` holds one row per customer (see `cdc.current_versions`); history rows would
    repeat a customer once per version.
    """
    stats = customer_stats(transactions, params)
    known = current_customers.select(
        F.col("customer_id").alias("_customer"), "full_name", "kyc_status", "account_status",
        F.col("risk_score").alias("profile_risk_score"), "account_age_days", "income_band",
        "is_politically_exposed", "country",
    )
    total = F.col("total_txns_30d")
    ten = F.lit(Decimal("10.0"))
    # Weight of each signal in the score.
    signals = [
        (_rate(F.col("confirmed_fraud_count"), total), "0.3"),
        (F.col("unique_devices_30d") / ten, "0.1"),
        (F.col("unique_cities_30d") / ten, "0.1"),
        (_rate(F.col("night_txn_count"), total), "0.15"),
        (_rate(F.col("foreign_txn_count"), total), "0.15"),
        (_rate(F.col("structuring_pattern_count"), total), "0.2"),
    ]
    score = sum((signal * F.lit(Decimal(weight)) for signal, weight in signals[1:]),
                signals[0][0] * F.lit(Decimal(signals[0][1])))
    tier = bands.first_match(
        [
            (F.col("confirmed_fraud_count") > 0, "CRITICAL"),
            (F.col("max_fraud_score") > 0.7, "HIGH"),
            ((F.col("unique_devices_30d") > 5) | (F.col("unique_cities_30d") > 5), "MEDIUM"),
        ],
        "LOW",
    )
    return (
        stats.join(known, stats["customer_id"] == known["_customer"], "left")
        .drop("_customer")
        .withColumns({
            "computed_risk_score": F.round(F.least(F.lit(Decimal("1.0")), score), 4),
            "customer_risk_tier": tier,
            "computed_at": F.current_timestamp(),
        })
    )


# ---- structuring and dashboard extracts ---------------------------------------------------------


def aml_structuring(transactions: DataFrame, params: RiskParams = RiskParams()) -> DataFrame:
    """Customers with repeated amounts just below the reporting limit."""
    return (
        transactions.filter(F.col("amount").between(params.structuring_low, params.structuring_high))
        .groupBy("customer_id")
        .agg(F.count(F.lit(1)).alias("structuring_count"))
        .filter(F.col("structuring_count") >= params.structuring_min_count)
    )


def ops_kpis(transactions: DataFrame) -> DataFrame:
    """Gross fraud value and volume per day."""
    fraud = F.col("is_fraud")
    return transactions.groupBy("transaction_date").agg(
        F.count(F.lit(1)).alias("txn_count"),
        F.count_if(fraud).alias("fraud_count"),
        _when_sum(fraud, F.col("amount")).alias("gross_fraud_value"),
    )


def fraud_hotspots(alerts: DataFrame) -> DataFrame:
    return alerts.groupBy("location_city").agg(
        F.count(F.lit(1)).alias("fraud_count"), F.sum("amount").alias("fraud_value")
    )


def fraud_type_mix(alerts: DataFrame) -> DataFrame:
    return alerts.groupBy("fraud_type", "alert_severity").agg(
        F.count(F.lit(1)).alias("alert_count"), F.sum("amount").alias("alert_value")
    )


def fraud_clusters(alerts: DataFrame, params: RiskParams = RiskParams()) -> DataFrame:
    """Heuristic segments of the alerts."""
    cluster = bands.first_match(
        [
            (F.col("fraud_type").isin(*params.velocity_fraud_types)
             & (F.col("amount") < params.micro_fraud_amount), "MICRO_VELOCITY_FRAUD"),
            (F.col("fraud_type") == "IMPOSSIBLE_TRAVEL", "GEO_ANOMALY_FRAUD"),
            ((F.col("fraud_score") >= params.high_value_fraud_score)
             & (F.col("amount") > params.high_value_fraud_amount), "HIGH_VALUE_FRAUD"),
        ],
        "GENERAL_FRAUD",
    )
    return (
        alerts.groupBy(cluster.alias("fraud_cluster"), "fraud_type")
        .agg(
            F.count(F.lit(1)).alias("fraud_count"),
            F.sum("amount").alias("total_fraud_amount"),
            F.avg("fraud_score").alias("avg_fraud_score"),
            F.countDistinct("customer_id").alias("unique_customers"),
            F.countDistinct("merchant_id").alias("unique_merchants"),
        )
        .withColumn("computed_at", F.current_timestamp())
    )
