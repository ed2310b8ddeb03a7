"""Fixed input schemas (DDL). Names and types are those of the messages and landing files."""

from __future__ import annotations

TRANSACTION = """
    transaction_id STRING, customer_id STRING, merchant_id STRING, amount DOUBLE, currency STRING,
    timestamp STRING, transaction_date STRING,
    location_city STRING, location_state STRING, location_country STRING,
    latitude DOUBLE, longitude DOUBLE, ip_address STRING, device_id STRING, device_type STRING,
    payment_method STRING, transaction_status STRING, merchant_category STRING,
    is_foreign_transaction BOOLEAN, failed_attempt_count INT, response_code STRING,
    hour_of_day INT, day_of_week INT, is_weekend BOOLEAN, is_night_transaction BOOLEAN,
    is_fraud BOOLEAN, fraud_type STRING, fraud_score DOUBLE,
    _kafka_produced_at STRING, _schema_version STRING
"""

ENVELOPE = """
    key BINARY, value BINARY, topic STRING, partition INT, offset BIGINT, timestamp TIMESTAMP
"""

CUSTOMER = """
    customer_id STRING, full_name STRING, email STRING, phone STRING, date_of_birth STRING,
    kyc_status STRING, account_status STRING, risk_score DOUBLE, account_age_days INT,
    country STRING, city STRING, state STRING, pin_code STRING, income_band STRING,
    device_fingerprint STRING, registered_devices STRING, preferred_payment STRING,
    typical_transaction_amount DOUBLE, typical_merchant_categories STRING,
    is_politically_exposed BOOLEAN, account_open_date STRING, last_login_date STRING,
    failed_login_count INT, is_synthetic_fraud_customer BOOLEAN, fraud_type STRING
"""

MERCHANT = """
    merchant_id STRING, merchant_name STRING, merchant_category STRING,
    merchant_category_code STRING, business_type STRING, country STRING, city STRING, state STRING,
    latitude DOUBLE, longitude DOUBLE, risk_category STRING, historical_fraud_score DOUBLE,
    avg_transaction_amount DOUBLE, monthly_transaction_volume INT, accepts_international BOOLEAN,
    is_high_risk_category BOOLEAN, merchant_tenure_days INT, chargeback_rate DOUBLE,
    registered_date STRING
"""

FX_RATE = "currency_code STRING, rate_date DATE, usd_multiplier DOUBLE"
