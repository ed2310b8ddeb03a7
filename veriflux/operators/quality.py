"""Named quality rules: SQL predicates that a row passes only when they are TRUE."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

Rules = Mapping[str, str]
ROWS = "_rows"

# Rule names, domains and limits.
BRONZE_RULES: Rules = {
    "transaction_id_present": "transaction_id IS NOT NULL",
    "amount_positive": "amount > 0",
    "timestamp_present": "timestamp IS NOT NULL",
    "customer_id_present": "customer_id IS NOT NULL",
}
CURRENCIES = ("INR", "USD", "EUR", "GBP", "AED", "SGD", "HKD")
PAYMENT_METHODS = ("UPI", "CREDIT_CARD", "DEBIT_CARD", "NETBANKING", "WALLET", "BNPL")
STATUSES = ("SUCCESS", "FAILED", "PENDING", "REVERSED")
DEVICE_TYPES = ("MOBILE", "DESKTOP", "POS", "ATM", "TABLET")
KYC_STATUSES = ("VERIFIED", "PENDING", "FAILED")
TIERS = ("LOW", "MEDIUM", "HIGH", "CRITICAL")

CUSTOMER_DROP_RULES: Rules = {"valid_customer_id": "customer_id IS NOT NULL"}
MERCHANT_DROP_RULES: Rules = {"valid_merchant_id": "merchant_id IS NOT NULL"}
FX_DROP_RULES: Rules = {"valid_currency": "currency_code IS NOT NULL"}
ALERT_FAIL_RULES: Rules = {"no_negative_fraud_score": "fraud_score >= 0.0"}


def one_of(expression: str, domain: Sequence[str]) -> str:
    return f"{expression} IN ({', '.join(repr(v) for v in domain)})"


CUSTOMER_TRACK_RULES: Rules = {"valid_kyc_status": one_of("kyc_status", KYC_STATUSES)}


def silver_rules(as_of: str | None = None, max_amount: float = 10_000_000, future_hours: int = 6) -> Rules:
    """Rules for cleaned transactions. Six hours absorb naive local times east of UTC."""
    now = f"TIMESTAMP '{as_of}'" if as_of else "CURRENT_TIMESTAMP()"
    return {
        "valid_amount_range": f"amount BETWEEN 0.01 AND {max_amount:.0f}",
        "valid_currency": one_of("UPPER(currency)", CURRENCIES),
        "valid_payment_method": one_of("UPPER(payment_method)", PAYMENT_METHODS),
        "valid_status": one_of("UPPER(transaction_status)", STATUSES),
        "valid_device_type": one_of("UPPER(device_type)", DEVICE_TYPES),
        "valid_fraud_score": "fraud_score BETWEEN 0.0 AND 1.0",
        "no_future_timestamp": f"event_timestamp <= {now} + INTERVAL {future_hours} HOURS",
    }


def gold_rules(score_column: str = "computed_risk_score") -> Rules:
    """Rules for customer profiles."""
    return {
        "no_negative_fraud_score": "max_fraud_score >= 0.0",
        "valid_risk_tier": one_of("customer_risk_tier", TIERS),
        "composite_score_bounded": f"{score_column} BETWEEN 0.0 AND 1.0",
    }


def passes(rule: str) -> Column:
    return F.coalesce(F.expr(rule), F.lit(False))


def passes_all(rules: Rules) -> Column:
    return reduce(Column.__and__, [passes(rule) for rule in rules.values()])


def violation_counts(rules: Rules) -> list[Column]:
    return [F.count_if(~passes(rule)).alias(name) for name, rule in rules.items()]


def track(df: DataFrame, rules: Rules, name: str = "expectations") -> tuple[DataFrame, Observation]:
    """Keeps every row of a batch frame; the observation holds the violation counts after its action."""
    observation = Observation(name)
    return df.observe(observation, *violation_counts(rules)), observation


def track_stream(df: DataFrame, rules: Rules, name: str = "expectations") -> DataFrame:
    """Keeps every row; counts show up per micro-batch under `observedMetrics` of the query progress, the number of rows
    as `_rows`. `streaming.rule_counts` stores them."""
    return df.observe(name, *violation_counts(rules), F.count(F.lit(1)).alias(ROWS))


def annotate(df: DataFrame, rules: Rules, column: str = "_violations") -> DataFrame:
    """Adds the names of the violated rules as an array."""
    marks = F.array(*[F.when(~passes(rule), F.lit(name)) for name, rule in rules.items()])
    return df.withColumn(column, F.array_compact(marks))


def drop_violations(df: DataFrame, rules: Rules) -> DataFrame:
    return df.filter(passes_all(rules))


def fail_on_violation(df: DataFrame, rules: Rules) -> DataFrame:
    """Raises on the first bad row. A filter, because an unused column would be pruned away."""
    checks = [
        F.when(passes(rule), F.lit(True)).otherwise(
            F.raise_error(F.lit(f"quality rule violated: {name}: {rule}")).cast("boolean")
        )
        for name, rule in rules.items()
    ]
    return df.filter(reduce(Column.__and__, checks))


def report(df: DataFrame, rules: Rules) -> DataFrame:
    """One row per rule: passed, failed and total rows. A single aggregation over `df`."""
    counts = df.agg(
        F.count(F.lit(1)).alias("total"),
        *[F.count_if(passes(rule)).alias(name) for name, rule in rules.items()],
    )
    return counts.unpivot("total", list(rules), "rule", "passed").select(
        "rule", "passed", (F.col("total") - F.col("passed")).alias("failed"), "total"
    )


def null_rates(df: DataFrame, columns: Sequence[str], max_pct: float) -> DataFrame:
    """Share of nulls per column and whether it calls for quarantine."""
    rates = df.agg(*[(100 * F.avg(F.col(c).isNull().cast("int"))).alias(c) for c in columns])
    return rates.unpivot([], list(columns), "column_name", "null_pct").withColumn(
        "quarantine", F.coalesce(F.col("null_pct") > max_pct, F.lit(False))
    )


def rejection_reason(malformed: Column | None = None) -> Column:
    """First reason to quarantine a transaction, or null for a row that may pass."""
    missing_id = F.col("transaction_id").isNull()
    missing_amount = F.col("amount").isNull()
    reason = (
        F.when(missing_id, "NULL_TRANSACTION_ID")
        .when(missing_amount, "NULL_AMOUNT")
        .when(F.col("amount") <= 0, "INVALID_AMOUNT")
    )
    return reason if malformed is None else F.when(malformed, "MALFORMED_JSON").otherwise(reason)


def split(df: DataFrame, malformed: Column | None = None) -> tuple[DataFrame, DataFrame]:
    """(valid rows, quarantined rows with their reason); together they are the input."""
    marked = df.withColumn("_quarantine_reason", rejection_reason(malformed))
    valid = marked.filter(F.col("_quarantine_reason").isNull()).drop("_quarantine_reason")
    rejected = marked.filter(F.col("_quarantine_reason").isNotNull())
    return valid, rejected.withColumn("_quarantined_at", F.current_timestamp())
