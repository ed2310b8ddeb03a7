"""Payment inputs derived from the driver tables.

Transactions come from `events`, merchants from `supplier`, customer change records from `orders`, and
exchange rates from the dates found in `events`. Only integer arithmetic and lookups are used, so that the
same rows can be stated in SQL (see `oracle.py`). Amounts and scores are multiples of a power of two: their
sums come out the same in any order of addition.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from veriflux.functions.bands import is_high_risk_category

AS_OF = "2024-01-31 00:00:00"
LATER = "2024-02-10 00:00:00"

# city, state, country, latitude, longitude; customers with few cities use the first three.
CITIES = (
    ("Pune", "MH", "IN", 18.52, 73.86),
    ("Mysore", "KA", "IN", 12.30, 76.64),
    ("Indore", "MP", "IN", 22.72, 75.86),
    ("Patna", "BR", "IN", 25.59, 85.14),
    ("Goa", "GA", "IN", 15.30, 74.12),
    ("Leh", "LA", "IN", 34.15, 77.58),
    ("Agra", "UP", "IN", 27.18, 78.01),
    ("Doha", "DA", "QA", 25.29, 51.53),
    ("Oslo", "OS", "NO", 59.91, 10.75),
    ("Lima", "LI", "PE", -12.05, -77.04),
    ("Cairo", "CA", "EG", 30.04, 31.24),
)
CATEGORIES = (
    "GROCERY", "FUEL", "TRAVEL", "FASHION", "TELECOM", "UTILITY", "ELECTRONICS",
    "JEWELRY", "MONEY_TRANSFER", "CRYPTO_EXCHANGE", "ONLINE_GAMING", "LUXURY_GOODS", "EDUCATION",
)
PAYMENTS = ("UPI", "CREDIT_CARD", "DEBIT_CARD", "NETBANKING", "WALLET", "BNPL")
DEVICES = ("MOBILE", "DESKTOP", "POS", "ATM", "TABLET")
FRAUD_TYPES = ("AML_STRUCTURING", "VELOCITY_FRAUD", "IMPOSSIBLE_TRAVEL", "DEVICE_ANOMALY", "ACCOUNT_TAKEOVER")
FX_CURRENCIES = ("INR", "USD", "EUR")

TXN_COLUMNS = (
    "transaction_id", "customer_id", "merchant_id", "amount", "currency", "timestamp", "transaction_date",
    "location_city", "location_state", "location_country", "latitude", "longitude", "ip_address",
    "device_id", "device_type", "payment_method", "transaction_status", "merchant_category",
    "is_foreign_transaction", "failed_attempt_count", "response_code", "hour_of_day", "day_of_week",
    "is_weekend", "is_night_transaction", "is_fraud", "fraud_type", "fraud_score",
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def pick(values: Sequence, index: Column) -> Column:
    items = ", ".join(f"{v!r}D" if isinstance(v, float) else repr(v) for v in values)
    return F.get(F.expr(f"array({items})"), index.cast("int"))


def transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One transaction per event; `offset` is its position in the feed."""
    events = table(spark, sf_dir, "events")
    merchants = table(spark, sf_dir, "supplier").agg(F.count(F.lit(1))).scalar()
    e, u, value, ts = F.col("event_id"), F.col("user_id"), F.col("value"), F.col("ts")
    k = F.from_json("props", "k INT")["k"]
    few = u % 4 == 1
    city = (e * 13) % F.when(few, 3).otherwise(len(CITIES))
    fraud = (k >= 50) & (e % 3 == 0) & (u % 3 == 0)
    return events.select(
        F.concat(F.lit("TXN_"), e.cast("string")).alias("transaction_id"),
        F.concat(F.lit("CUST_"), u.cast("string")).alias("customer_id"),
        F.concat(
            F.lit("MERCH_"),
            F.when(e % 6 == 0, 1000000 + e % 50).otherwise((e * 7) % merchants).cast("string"),
        ).alias("merchant_id"),
        F.when(e % 20 == 0, (9000 + e % 1000).cast("double"))
        .when(e % 97 == 0, F.floor(value * 1000).cast("double"))
        .otherwise(F.floor(value * 80) / F.lit(4.0)).alias("amount"),
        F.when(e % 10 == 8, "USD").when(e % 10 == 9, "EUR").otherwise("INR").alias("currency"),
        F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").alias("timestamp"),
        ts.cast("date").alias("transaction_date"),
        *[
            pick([row[i] for row in CITIES], city).alias(name)
            for i, name in enumerate(
                ("location_city", "location_state", "location_country", "latitude", "longitude"))
        ],
        F.concat(F.lit("10.0."), (e % 7).cast("string"), F.lit("."), (u % 250).cast("string")).alias("ip_address"),
        F.concat(F.lit("DEV_"), (e % F.when(few, 3).otherwise(11)).cast("string")).alias("device_id"),
        pick(DEVICES, e % len(DEVICES)).alias("device_type"),
        pick(PAYMENTS, e % len(PAYMENTS)).alias("payment_method"),
        F.when(F.col("event_type") == "error", "FAILED")
        .when(F.col("event_type") == "signup", "PENDING")
        .otherwise("SUCCESS").alias("transaction_status"),
        pick(CATEGORIES, (e * 5) % len(CATEGORIES)).alias("merchant_category"),
        (pick([row[2] for row in CITIES], city) != "IN").alias("is_foreign_transaction"),
        (e % 4).cast("int").alias("failed_attempt_count"),
        F.lit("00").alias("response_code"),
        F.hour(ts).alias("hour_of_day"),
        F.weekday(ts).alias("day_of_week"),
        (F.weekday(ts) >= 5).alias("is_weekend"),
        ((F.hour(ts) < 5) | (F.hour(ts) >= 23)).alias("is_night_transaction"),
        fraud.alias("is_fraud"),
        F.when(fraud, pick(FRAUD_TYPES, e % len(FRAUD_TYPES))).alias("fraud_type"),
        F.when(fraud, (k + 20) / F.lit(128.0)).otherwise(k * 29 / F.lit(4096.0)).alias("fraud_score"),
        ts.alias("event_timestamp"),
        e.alias("offset"),
    )


def landing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Transactions as a landing file holds them: no event time, no feed position."""
    return transactions(spark, sf_dir).select(*TXN_COLUMNS)


def messy(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Transactions with damage in every column that a rule looks at."""
    o = F.col("offset")

    def damage(column: str, every: int, value: Column | str | float | None) -> Column:
        broken = value if isinstance(value, Column) else F.lit(value)
        return F.when(o % every != 0, F.col(column)).otherwise(broken)

    return transactions(spark, sf_dir).withColumns({
        "transaction_id": damage("transaction_id", 101, None),
        "amount": F.when(o % 103 == 0, F.lit(None)).otherwise(damage("amount", 107, F.lit(-1) * F.col("amount"))),
        "timestamp": damage("timestamp", 109, None),
        "customer_id": damage("customer_id", 13, None),
        "currency": F.when(o % 37 == 0, "XXX").otherwise(damage("currency", 41, F.lower("currency"))),
        "transaction_status": damage("transaction_status", 43, "UNKNOWN"),
        "event_timestamp": damage("event_timestamp", 47, F.col("event_timestamp") + F.expr("INTERVAL 400 DAYS")),
        "fraud_score": damage("fraud_score", 53, 1.5),
        "device_type": damage("device_type", 59, None),
    })


def transaction_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three change records per transaction: created, amount withheld, settled. `offset` is unique."""
    step = F.col("step")
    records = transactions(spark, sf_dir).withColumn("step", F.explode(F.sequence(F.lit(0), F.lit(2))))
    return records.withColumns({
        "amount": F.when(step == 1, F.lit(None)).when(step == 2, F.col("amount") + 1).otherwise(F.col("amount")),
        "transaction_status": F.when(step == 0, "PENDING").otherwise(F.col("transaction_status")),
        "device_id": F.when(step == 2, F.lit(None)).otherwise(
            F.concat("device_id", F.lit("_"), step.cast("string"))),
        "offset": F.col("offset") * 3 + step,
    }).drop("step")


def merchants(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = F.col("s_suppkey")
    return table(spark, sf_dir, "supplier").select(
        F.concat(F.lit("MERCH_"), s.cast("string")).alias("merchant_id"),
        F.col("s_name").alias("merchant_name"),
        pick(CATEGORIES, s % len(CATEGORIES)).alias("merchant_category"),
        F.when(s % 100 > 70, "VERY_HIGH").when(s % 100 > 40, "HIGH").otherwise("LOW").alias("risk_category"),
        pick([row[0] for row in CITIES], s % len(CITIES)).alias("city"),
        pick([row[1] for row in CITIES], s % len(CITIES)).alias("state"),
        (((s * 37) % 100) / F.lit(100.0)).alias("historical_fraud_score"),
        ((s * 53) % 3650).cast("int").alias("merchant_tenure_days"),
    )


def merchant_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three records per merchant, some with withheld values; `seq` orders them."""
    step = F.col("seq")
    records = merchants(spark, sf_dir).withColumn("seq", F.explode(F.sequence(F.lit(1), F.lit(3))))
    return records.withColumns({
        "merchant_name": F.concat("merchant_name", F.lit(" v"), step.cast("string")),
        "city": F.when((step == 3) & (F.col("merchant_tenure_days") % 2 == 0), F.lit(None)).otherwise(
            F.concat("city", F.lit(" "), step.cast("string"))),
        "risk_category": F.when(step > 1, F.lit(None)).otherwise(F.col("risk_category")),
    })


def customer_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One change record per order, in the order (changed_at, change_id)."""
    o = F.col("o_orderkey")
    status = F.col("o_orderstatus")
    priority = F.substring("o_orderpriority", 1, 1)
    return table(spark, sf_dir, "orders").select(
        F.concat(F.lit("CUST_"), F.col("o_custkey").cast("string")).alias("customer_id"),
        F.concat(F.lit("Customer "), F.col("o_custkey").cast("string")).alias("full_name"),
        F.when(status == "F", "VERIFIED").when(status == "O", "PENDING").otherwise("FAILED").alias("kyc_status"),
        F.when(o % 10 == 0, "SUSPENDED").otherwise("ACTIVE").alias("account_status"),
        F.when(status == "F", 0.1).when(status == "O", 0.3).otherwise(0.8).alias("risk_score"),
        (o % 2000).cast("int").alias("account_age_days"),
        F.lit("IN").alias("country"),
        F.when(o % 7 == 0, F.lit(None)).otherwise("Pune").alias("city"),
        F.lit("MH").alias("state"),
        F.when(priority == "1", "ULTRA_HIGH").when(priority == "2", "HIGH").otherwise("LOW").alias("income_band"),
        (F.col("o_custkey") % 50 == 0).alias("is_politically_exposed"),
        F.col("o_totalprice").alias("typical_transaction_amount"),
        F.col("o_orderdate").alias("changed_at"),
        o.alias("change_id"),
    )


def fx_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rates per currency and date of the feed, each ingested twice; EUR is missing on every seventh day."""
    dates = table(spark, sf_dir, "events").select(F.col("ts").cast("date").alias("rate_date")).distinct()
    day = F.dayofmonth("rate_date")
    rows = dates.select(
        "rate_date",
        F.explode(F.array(*[F.lit(c) for c in FX_CURRENCIES])).alias("currency_code"),
    ).filter((F.col("currency_code") != "EUR") | (day % 7 != 0))
    base = F.when(F.col("currency_code") == "USD", 100).when(F.col("currency_code") == "EUR", 108).otherwise(2)
    return rows.withColumn("ingest_no", F.explode(F.sequence(F.lit(1), F.lit(2)))).select(
        "currency_code", "rate_date",
        ((base * 100 + day + F.col("ingest_no")) / F.lit(10000.0)).alias("usd_multiplier"),
        F.col("ingest_no").alias("_ingested_at"),
    )


def envelopes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Transactions as bus messages; every fiftieth body is cut off."""
    body = F.to_json(F.struct(*TXN_COLUMNS))
    return transactions(spark, sf_dir).select(
        F.col("customer_id").cast("binary").alias("key"),
        F.when(F.col("offset") % 50 == 0, F.concat(F.lit("{{"), F.substring(body, 1, 20)))
        .otherwise(body).cast("binary").alias("value"),
        F.lit("payments").alias("topic"),
        (F.col("offset") % 3).cast("int").alias("partition"),
        F.col("offset").alias("offset"),
        F.col("event_timestamp").cast("timestamp").alias("timestamp"),
    )


def customer_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customer landing rows with all columns of the file; every fortieth lacks its id."""
    c = F.col("c_custkey")
    devices = F.array(F.concat(F.lit("D"), c.cast("string")), F.concat(F.lit("E"), (c % 9).cast("string")))
    return table(spark, sf_dir, "customer").select(
        F.when(c % 40 != 0, F.concat(F.lit("CUST_"), c.cast("string"))).alias("customer_id"),
        F.col("c_name").alias("full_name"),
        F.concat(F.lit("c"), c.cast("string"), F.lit("@example.org")).alias("email"),
        F.concat(F.lit("+91"), (c + 6000000000).cast("string")).alias("phone"),
        F.lit("1980-05-17").alias("date_of_birth"),
        pick(("VERIFIED", "PENDING", "FAILED", "EXPIRED"), c % 4).alias("kyc_status"),
        pick(("ACTIVE", "SUSPENDED", "UNDER_REVIEW"), c % 3).alias("account_status"),
        ((c % 64) / F.lit(64.0)).alias("risk_score"),
        (c % 2000).cast("int").alias("account_age_days"),
        F.lit("IN").alias("country"),
        pick([row[0] for row in CITIES], c % len(CITIES)).alias("city"),
        pick([row[1] for row in CITIES], c % len(CITIES)).alias("state"),
        (c + 100000).cast("string").alias("pin_code"),
        pick(("LOW", "MEDIUM", "HIGH", "ULTRA_HIGH"), c % 4).alias("income_band"),
        F.concat(F.lit("FP"), c.cast("string")).alias("device_fingerprint"),
        F.concat_ws("|", devices).alias("registered_devices"),
        pick(PAYMENTS, c % len(PAYMENTS)).alias("preferred_payment"),
        F.col("c_acctbal").alias("typical_transaction_amount"),
        F.concat_ws("|", F.lit("FUEL"), F.col("c_mktsegment")).alias("typical_merchant_categories"),
        (c % 50 == 0).alias("is_politically_exposed"),
        F.lit("2020-01-01").alias("account_open_date"),
        F.lit("2024-01-01").alias("last_login_date"),
        (c % 11).cast("int").alias("failed_login_count"),
        (c % 5 == 0).alias("is_synthetic_fraud_customer"),
        F.when(c % 5 == 0, pick(FRAUD_TYPES, c % 4)).alias("fraud_type"),
    )


def merchant_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Merchant landing rows with all columns of the file; every ninth lacks its id."""
    s = F.col("s_suppkey")
    return table(spark, sf_dir, "supplier").select(
        F.when(s % 9 != 0, F.concat(F.lit("MERCH_"), s.cast("string"))).alias("merchant_id"),
        F.col("s_name").alias("merchant_name"),
        pick(CATEGORIES, s % len(CATEGORIES)).alias("merchant_category"),
        (s + 4000).cast("string").alias("merchant_category_code"),
        pick(("ONLINE", "PHYSICAL", "HYBRID"), s % 3).alias("business_type"),
        F.lit("IN").alias("country"),
        pick([row[0] for row in CITIES], s % len(CITIES)).alias("city"),
        pick([row[1] for row in CITIES], s % len(CITIES)).alias("state"),
        pick([row[3] for row in CITIES], s % len(CITIES)).alias("latitude"),
        pick([row[4] for row in CITIES], s % len(CITIES)).alias("longitude"),
        F.when(s % 2 == 0, "LOW").otherwise("HIGH").alias("risk_category"),
        ((s % 64) / F.lit(64.0)).alias("historical_fraud_score"),
        F.col("s_acctbal").alias("avg_transaction_amount"),
        (s * 10).cast("int").alias("monthly_transaction_volume"),
        (s % 3 == 0).alias("accepts_international"),
        is_high_risk_category(pick(CATEGORIES, s % len(CATEGORIES))).alias("is_high_risk_category"),
        ((s * 53) % 3650).cast("int").alias("merchant_tenure_days"),
        ((s % 16) / F.lit(64.0)).alias("chargeback_rate"),
        F.lit("2021-06-01").alias("registered_date"),
    )
