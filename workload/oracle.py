"""The registered queries as SQL over the driver tables (DuckDB dialect)."""

from __future__ import annotations

from workload.inputs import (
    AS_OF, CATEGORIES, CITIES, DEVICES, FRAUD_TYPES, FX_CURRENCIES, LATER, PAYMENTS, TXN_COLUMNS,
)


def _list(values) -> str:
    return "[" + ", ".join(repr(v) for v in values) + "]"


def _pick(values, index: str) -> str:
    return f"({_list(values)})[CAST({index} AS BIGINT) + 1]"


def half_up(expression: str, digits: int) -> str:
    """Decimal rounding of a double, ties away from zero."""
    return f"CAST(CAST(CAST({expression} AS DECIMAL(38,14)) AS DECIMAL(38,{digits})) AS DOUBLE)"


def _json_int(column: str, field: str) -> str:
    return f"CAST(json_extract_string({column}, '$.{field}') AS INTEGER)"


# ---- inputs as common table expressions ---------------------------------------------------------

_CITY = f"(event_id * 13) % (CASE WHEN user_id % 4 = 1 THEN 3 ELSE {len(CITIES)} END)"
_FRAUD = "(k >= 50 AND event_id % 3 = 0 AND user_id % 3 = 0)"
_HOUR = "CAST(hour(ts) AS BIGINT)"
_DAY = "CAST(isodow(ts) - 1 AS BIGINT)"

TXN = f"""
ev AS (SELECT *, {_json_int('props', 'k')} AS k FROM events),
txn AS (
  SELECT
    'TXN_' || CAST(event_id AS VARCHAR) AS transaction_id,
    'CUST_' || CAST(user_id AS VARCHAR) AS customer_id,
    'MERCH_' || CAST(CASE WHEN event_id % 6 = 0 THEN 1000000 + event_id % 50
      ELSE (event_id * 7) % (SELECT count(*) FROM supplier) END AS VARCHAR) AS merchant_id,
    CASE WHEN event_id % 20 = 0 THEN CAST(9000 + event_id % 1000 AS DOUBLE)
      WHEN event_id % 97 = 0 THEN CAST(floor(value * 1000) AS DOUBLE)
      ELSE floor(value * 80) / CAST(4 AS DOUBLE) END AS amount,
    CASE event_id % 10 WHEN 8 THEN 'USD' WHEN 9 THEN 'EUR' ELSE 'INR' END AS currency,
    strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') AS "timestamp",
    CAST(ts AS DATE) AS transaction_date,
    {_pick([c[0] for c in CITIES], _CITY)} AS location_city,
    {_pick([c[1] for c in CITIES], _CITY)} AS location_state,
    {_pick([c[2] for c in CITIES], _CITY)} AS location_country,
    CAST({_pick([c[3] for c in CITIES], _CITY)} AS DOUBLE) AS latitude,
    CAST({_pick([c[4] for c in CITIES], _CITY)} AS DOUBLE) AS longitude,
    '10.0.' || CAST(event_id % 7 AS VARCHAR) || '.' || CAST(user_id % 250 AS VARCHAR) AS ip_address,
    'DEV_' || CAST(event_id % (CASE WHEN user_id % 4 = 1 THEN 3 ELSE 11 END) AS VARCHAR) AS device_id,
    {_pick(DEVICES, f'event_id % {len(DEVICES)}')} AS device_type,
    {_pick(PAYMENTS, f'event_id % {len(PAYMENTS)}')} AS payment_method,
    CASE event_type WHEN 'error' THEN 'FAILED' WHEN 'signup' THEN 'PENDING' ELSE 'SUCCESS' END AS transaction_status,
    {_pick(CATEGORIES, f'(event_id * 5) % {len(CATEGORIES)}')} AS merchant_category,
    {_pick([c[2] for c in CITIES], _CITY)} <> 'IN' AS is_foreign_transaction,
    event_id % 4 AS failed_attempt_count,
    '00' AS response_code,
    {_HOUR} AS hour_of_day,
    {_DAY} AS day_of_week,
    {_DAY} >= 5 AS is_weekend,
    ({_HOUR} < 5 OR {_HOUR} >= 23) AS is_night_transaction,
    {_FRAUD} AS is_fraud,
    CASE WHEN {_FRAUD} THEN {_pick(FRAUD_TYPES, f'event_id % {len(FRAUD_TYPES)}')} END AS fraud_type,
    CASE WHEN {_FRAUD} THEN (k + 20) / CAST(128 AS DOUBLE) ELSE k * 29 / CAST(4096 AS DOUBLE) END AS fraud_score,
    ts AS event_timestamp,
    event_id AS "offset"
  FROM ev
)"""

MESSY = TXN + """,
messy AS (
  SELECT * REPLACE (
    CASE WHEN "offset" % 101 <> 0 THEN transaction_id END AS transaction_id,
    CASE WHEN "offset" % 103 = 0 THEN NULL WHEN "offset" % 107 <> 0 THEN amount ELSE -1 * amount END AS amount,
    CASE WHEN "offset" % 109 <> 0 THEN "timestamp" END AS "timestamp",
    CASE WHEN "offset" % 13 <> 0 THEN customer_id END AS customer_id,
    CASE WHEN "offset" % 37 = 0 THEN 'XXX' WHEN "offset" % 41 <> 0 THEN currency ELSE lower(currency) END AS currency,
    CASE WHEN "offset" % 43 <> 0 THEN transaction_status ELSE 'UNKNOWN' END AS transaction_status,
    CASE WHEN "offset" % 47 <> 0 THEN event_timestamp ELSE event_timestamp + INTERVAL 400 DAYS END AS event_timestamp,
    CASE WHEN "offset" % 53 <> 0 THEN fraud_score ELSE 1.5 END AS fraud_score,
    CASE WHEN "offset" % 59 <> 0 THEN device_type END AS device_type)
  FROM txn
)"""

TXN_CHANGES = TXN + """,
steps AS (SELECT txn.*, s.step FROM txn, (VALUES (0), (1), (2)) AS s(step)),
changes AS (
  SELECT * REPLACE (
    CASE step WHEN 1 THEN NULL WHEN 2 THEN amount + 1 ELSE amount END AS amount,
    CASE WHEN step = 0 THEN 'PENDING' ELSE transaction_status END AS transaction_status,
    CASE WHEN step <> 2 THEN device_id || '_' || CAST(step AS VARCHAR) END AS device_id,
    "offset" * 3 + step AS "offset")
  FROM steps
),
cleaned AS (
  SELECT transaction_id,
    arg_max(customer_id, "offset") AS customer_id,
    arg_max(amount, "offset") FILTER (WHERE amount IS NOT NULL) AS amount,
    arg_max(currency, "offset") AS currency,
    arg_max(transaction_date, "offset") AS transaction_date,
    arg_max(transaction_status, "offset") AS transaction_status,
    arg_max(device_id, "offset") FILTER (WHERE device_id IS NOT NULL) AS device_id,
    arg_max(fraud_score, "offset") AS fraud_score,
    arg_max(event_timestamp, "offset") AS event_timestamp
  FROM changes GROUP BY transaction_id
)"""

MERCHANTS = f"""
merch AS (
  SELECT 'MERCH_' || CAST(s_suppkey AS VARCHAR) AS merchant_id, s_name AS merchant_name,
    {_pick(CATEGORIES, f's_suppkey % {len(CATEGORIES)}')} AS merchant_category,
    CASE WHEN s_suppkey % 100 > 70 THEN 'VERY_HIGH' WHEN s_suppkey % 100 > 40 THEN 'HIGH' ELSE 'LOW' END
      AS risk_category,
    {_pick([c[0] for c in CITIES], f's_suppkey % {len(CITIES)}')} AS city,
    {_pick([c[1] for c in CITIES], f's_suppkey % {len(CITIES)}')} AS state,
    ((s_suppkey * 37) % 100) / CAST(100 AS DOUBLE) AS historical_fraud_score,
    (s_suppkey * 53) % 3650 AS merchant_tenure_days
  FROM supplier
)"""

HISTORY = """
cust AS (
  SELECT 'CUST_' || CAST(o_custkey AS VARCHAR) AS customer_id,
    'Customer ' || CAST(o_custkey AS VARCHAR) AS full_name,
    CASE o_orderstatus WHEN 'F' THEN 'VERIFIED' WHEN 'O' THEN 'PENDING' ELSE 'FAILED' END AS kyc_status,
    CASE WHEN o_orderkey % 10 = 0 THEN 'SUSPENDED' ELSE 'ACTIVE' END AS account_status,
    CAST(CASE o_orderstatus WHEN 'F' THEN 0.1 WHEN 'O' THEN 0.3 ELSE 0.8 END AS DOUBLE) AS risk_score,
    o_orderkey % 2000 AS account_age_days,
    'IN' AS country,
    CASE WHEN o_orderkey % 7 <> 0 THEN 'Pune' END AS city,
    'MH' AS state,
    CASE substr(o_orderpriority, 1, 1) WHEN '1' THEN 'ULTRA_HIGH' WHEN '2' THEN 'HIGH' ELSE 'LOW' END AS income_band,
    o_custkey % 50 = 0 AS is_politically_exposed,
    o_totalprice AS typical_transaction_amount,
    o_orderdate AS changed_at,
    o_orderkey AS change_id
  FROM orders
),
flagged AS (
  SELECT *, CASE WHEN lag(change_id) OVER w IS NULL
      OR kyc_status IS DISTINCT FROM lag(kyc_status) OVER w
      OR account_status IS DISTINCT FROM lag(account_status) OVER w
      OR risk_score IS DISTINCT FROM lag(risk_score) OVER w
      OR city IS DISTINCT FROM lag(city) OVER w
      OR state IS DISTINCT FROM lag(state) OVER w
      OR income_band IS DISTINCT FROM lag(income_band) OVER w
      OR is_politically_exposed IS DISTINCT FROM lag(is_politically_exposed) OVER w
    THEN 1 ELSE 0 END AS is_start
  FROM cust WINDOW w AS (PARTITION BY customer_id ORDER BY changed_at, change_id)
),
numbered AS (
  SELECT *, sum(is_start) OVER (PARTITION BY customer_id ORDER BY changed_at, change_id
                                ROWS UNBOUNDED PRECEDING) AS version
  FROM flagged
),
spans AS (
  SELECT *, min(changed_at) OVER (PARTITION BY customer_id, version) AS valid_from,
    row_number() OVER (PARTITION BY customer_id, version ORDER BY changed_at DESC, change_id DESC) AS back
  FROM numbered
),
hist AS (
  SELECT customer_id, full_name, kyc_status, account_status, risk_score, account_age_days, country, city, state,
    income_band, is_politically_exposed, typical_transaction_amount, changed_at, change_id, valid_from,
    lead(valid_from) OVER (PARTITION BY customer_id ORDER BY version) AS valid_to
  FROM spans WHERE back = 1
)"""
FX = f"""
days AS (SELECT DISTINCT CAST(ts AS DATE) AS rate_date FROM events),
fx AS (
  SELECT c.currency_code, rate_date,
    ((CASE c.currency_code WHEN 'USD' THEN 100 WHEN 'EUR' THEN 108 ELSE 2 END) * 100
      + day(rate_date) + n.ingest_no) / CAST(10000 AS DOUBLE) AS usd_multiplier,
    n.ingest_no
  FROM days, (SELECT unnest({_list(FX_CURRENCIES)}) AS currency_code) AS c, (VALUES (1), (2)) AS n(ingest_no)
  WHERE c.currency_code <> 'EUR' OR day(rate_date) % 7 <> 0
),
rates AS (
  SELECT currency_code, rate_date, arg_max(usd_multiplier, ingest_no) AS usd_multiplier FROM fx GROUP BY ALL
),
priced AS (
  SELECT txn.*, coalesce(amount * usd_multiplier, amount) AS amount_usd
  FROM txn LEFT JOIN rates ON currency = currency_code AND transaction_date = rate_date
)"""

RISK_BAND = ("CASE WHEN fraud_score >= 0.8 THEN 'CRITICAL' WHEN fraud_score >= 0.6 THEN 'HIGH' "
             "WHEN fraud_score >= 0.4 THEN 'MEDIUM' ELSE 'LOW' END")


def amount_band(column: str) -> str:
    return (f"CASE WHEN {column} < 100 THEN 'MICRO (<100)' WHEN {column} < 1000 THEN 'SMALL (100-1K)' "
            f"WHEN {column} < 10000 THEN 'MEDIUM (1K-10K)' WHEN {column} < 100000 THEN 'LARGE (10K-100K)' "
            "ELSE 'VERY_LARGE (>100K)' END")


HIGH_RISK = "merchant_category IN ('CRYPTO_EXCHANGE','MONEY_TRANSFER','ONLINE_GAMING','JEWELRY','LUXURY_GOODS')"

BRONZE_PREDICATES = {
    "transaction_id_present": "transaction_id IS NOT NULL",
    "amount_positive": "amount > 0",
    "timestamp_present": '"timestamp" IS NOT NULL',
    "customer_id_present": "customer_id IS NOT NULL",
}
SILVER_PREDICATES = {
    "valid_amount_range": "amount BETWEEN 0.01 AND 10000000",
    "valid_currency": "upper(currency) IN ('INR','USD','EUR','GBP','AED','SGD','HKD')",
    "valid_payment_method":
        "upper(payment_method) IN ('UPI','CREDIT_CARD','DEBIT_CARD','NETBANKING','WALLET','BNPL')",
    "valid_status": "upper(transaction_status) IN ('SUCCESS','FAILED','PENDING','REVERSED')",
    "valid_device_type": "upper(device_type) IN ('MOBILE','DESKTOP','POS','ATM','TABLET')",
    "valid_fraud_score": "fraud_score BETWEEN 0.0 AND 1.0",
    "no_future_timestamp": f"event_timestamp <= TIMESTAMP '{AS_OF}' + INTERVAL 6 HOURS",
}
GOLD_PREDICATES = {
    "no_negative_fraud_score": "max_fraud_score >= 0.0",
    "valid_risk_tier": "customer_risk_tier IN ('LOW','MEDIUM','HIGH','CRITICAL')",
    "composite_score_bounded": "computed_risk_score BETWEEN 0.0 AND 1.0",
}


def violations(predicates: dict[str, str]) -> str:
    marks = ", ".join(f"CASE WHEN NOT coalesce({p}, FALSE) THEN '{n}' END" for n, p in predicates.items())
    return f"concat_ws(',', {marks})"


def all_pass(predicates: dict[str, str]) -> str:
    return " AND ".join(f"coalesce({p}, FALSE)" for p in predicates.values())


def recent(as_of: str = AS_OF) -> str:
    return f"event_timestamp >= TIMESTAMP '{as_of}' - INTERVAL 30 DAYS"


LANDED_CLEANED = f"""
landed AS (
  SELECT *, row_number() OVER (PARTITION BY transaction_id ORDER BY "offset") AS copy FROM messy
),
landed_cleaned AS (
  SELECT *, amount AS amount_usd, 'S3_BATCH' AS _processing_path,
    CASE WHEN fraud_score >= 0.8 THEN 'CRITICAL' ELSE 'LOW' END AS risk_band
  FROM landed WHERE copy = 1 AND {all_pass(SILVER_PREDICATES)}
)"""

ALERTS = """
alerts AS (
  SELECT 'ALERT_' || transaction_id AS alert_id, transaction_id, customer_id, merchant_id, amount, currency,
    event_timestamp, fraud_type, fraud_score,
    CASE WHEN fraud_score >= 0.90 THEN 'CRITICAL' WHEN fraud_score >= 0.75 THEN 'HIGH' ELSE 'MEDIUM' END
      AS alert_severity,
    location_city, location_country, payment_method, device_id,
    concat_ws(' | ', 'FRAUD ALERT', fraud_type, 'Score:' || CAST(fraud_score AS VARCHAR),
      'Amount:₹' || CAST(amount AS VARCHAR), customer_id, location_city) AS alert_message
  FROM txn WHERE is_fraud AND fraud_score >= 0.60
)"""

CHORD = """pow(sin((radians(latitude) - radians(prev_latitude)) / 2), 2)
      + cos(radians(prev_latitude)) * cos(radians(latitude))
      * pow(sin((radians(longitude) - radians(prev_longitude)) / 2), 2)"""

PAIRS = """
pairs AS (
  SELECT *,
    lag(event_timestamp) OVER w AS prev_event_timestamp,
    lag(latitude) OVER w AS prev_latitude, lag(longitude) OVER w AS prev_longitude,
    lag(location_city) OVER w AS prev_location_city, lag(location_country) OVER w AS prev_location_country,
    lag(transaction_id) OVER w AS prev_transaction_id
  FROM txn WHERE {where}
  WINDOW w AS (PARTITION BY customer_id ORDER BY event_timestamp, transaction_id)
)"""


def _epoch(column: str) -> str:
    return f"CAST(floor(epoch({column})) AS BIGINT)"


TRAVEL = f"""
measured AS (
  SELECT *, 2 * 6371 * asin(sqrt(least(CAST(1 AS DOUBLE), {CHORD}))) AS km,
    CAST(round(({_epoch('event_timestamp')} - {_epoch('prev_event_timestamp')}) / 3600.0, 6) AS DECIMAL(27,6)) AS gap
  FROM pairs WHERE prev_event_timestamp IS NOT NULL AND prev_latitude IS NOT NULL
),
speeds AS (SELECT *, km / nullif(CAST(gap AS DOUBLE), 0) AS speed FROM measured),
travel AS (
  SELECT customer_id, transaction_id AS txn_id_2, prev_transaction_id AS txn_id_1,
    prev_location_city AS from_city, location_city AS to_city,
    prev_location_country AS from_country, location_country AS to_country,
    {half_up('km', 2)} AS distance_km,
    CAST(CAST(gap AS DECIMAL(27,4)) AS DOUBLE) AS time_gap_hours,
    round(speed, 0) AS implied_speed_kmh, amount, event_timestamp,
    'IMPOSSIBLE_TRAVEL' AS fraud_pattern,
    CAST(CASE WHEN speed > 100 THEN 0.99 WHEN speed > 50 THEN 0.95 WHEN speed > 1 THEN 0.85 ELSE 0.5 END AS DOUBLE)
      AS impossible_travel_score
  FROM speeds WHERE speed > 0.1 AND km > 0.1
)"""


def velocity(key: str, unit: str) -> tuple[str, str]:
    """The grouping as a table expression and the select over it."""
    grouped = f"""
grouped AS (
  SELECT {key}, CAST(date_trunc('{unit}', event_timestamp) AS TIMESTAMP) AS hour_window, count(*) AS txn_count,
    sum(amount) AS total_amount, count(DISTINCT merchant_id) AS unique_merchants,
    count(DISTINCT device_id) AS unique_devices, count(DISTINCT location_city) AS unique_cities,
    min(event_timestamp) AS first_txn_time, max(event_timestamp) AS last_txn_time,
    avg(fraud_score) AS avg_fraud_score
  FROM source WHERE {recent()} AND transaction_status <> 'FAILED' GROUP BY ALL
)"""
    return grouped, f"""SELECT {key}, hour_window, txn_count, total_amount, unique_merchants, unique_devices, unique_cities,
  first_txn_time, last_txn_time, date_sub('minute', first_txn_time, last_txn_time) AS window_duration_minutes,
  avg_fraud_score,
  CAST(CASE WHEN txn_count > 30 THEN 1.0 WHEN txn_count > 20 THEN 0.9 WHEN txn_count > 15 THEN 0.7
    WHEN txn_count > 10 THEN 0.5 ELSE 0.2 END AS DOUBLE) AS velocity_score,
  concat_ws(',',
    CASE WHEN txn_count > 1 THEN 'HIGH_VELOCITY:' || CAST(txn_count AS VARCHAR) || '_txns' ELSE '-' END,
    CASE WHEN unique_devices > 2 THEN 'MULTI_DEVICE:' || CAST(unique_devices AS VARCHAR) ELSE '-' END,
    CASE WHEN unique_cities > 2 THEN 'MULTI_CITY_VELOCITY' ELSE '-' END) AS risk_factors
FROM grouped WHERE txn_count >= 1"""


RATE = "(count_if(is_fraud) / CAST(count(*) AS DOUBLE))"

MERCHANT_SCORES = f"""
facts AS (
  SELECT merchant_id AS mid, count(*) AS total_transactions, count(DISTINCT customer_id) AS unique_customers,
    sum(amount) AS total_volume_inr, avg(amount) AS avg_transaction_amount,
    CAST(count_if(is_fraud) AS BIGINT) AS fraud_count,
    sum(CASE WHEN is_fraud THEN amount ELSE 0 END) AS fraud_amount_inr,
    {half_up('100.0 * count_if(is_fraud) / count(*)', 4)} AS fraud_rate_pct,
    avg(fraud_score) AS avg_fraud_score, max(fraud_score) AS max_fraud_score,
    count(DISTINCT fraud_type) AS distinct_fraud_types,
    CAST(count_if(is_night_transaction AND amount > 10000) AS BIGINT) AS high_value_night_txns,
    CAST(count_if(failed_attempt_count > 0) AS BIGINT) AS transactions_with_failures,
    {RATE} AS rate
  FROM txn WHERE {recent()} GROUP BY merchant_id
),
scores AS (
  SELECT mid AS merchant_id, merchant_name, merchant_category, risk_category, city, state, total_transactions,
    unique_customers, total_volume_inr, avg_transaction_amount, fraud_count, fraud_amount_inr, fraud_rate_pct,
    avg_fraud_score, max_fraud_score, distinct_fraud_types, high_value_night_txns, transactions_with_failures,
    CASE WHEN historical_fraud_score IS NULL THEN CAST(1 AS DOUBLE) ELSE
      {half_up('''least(1.0, historical_fraud_score * CAST(0.4 AS DOUBLE) + rate * CAST(0.4 AS DOUBLE)
        + CASE WHEN merchant_tenure_days < 90 THEN 0.2 ELSE 0.0 END)''', 4)} END AS computed_risk_score,
    CASE WHEN historical_fraud_score > 0.7 OR rate > 0.15 THEN 'CRITICAL'
      WHEN historical_fraud_score > 0.4 OR rate > 0.08 THEN 'HIGH'
      WHEN historical_fraud_score > 0.2 THEN 'MEDIUM' ELSE 'LOW' END AS merchant_risk_tier
  FROM facts LEFT JOIN merch ON mid = merchant_id
)"""

CUSTOMER_STATS = f"""
stats AS (
  SELECT customer_id, count(*) AS total_txns_30d, sum(amount) AS total_spend_30d, avg(amount) AS avg_txn_amount,
    max(amount) AS max_single_txn, round(stddev_samp(amount), 6) AS txn_amount_stddev,
    count(DISTINCT device_id) AS unique_devices_30d, count(DISTINCT location_city) AS unique_cities_30d,
    count(DISTINCT merchant_category) AS unique_merchant_cats, count(DISTINCT ip_address) AS unique_ips_30d,
    avg(hour_of_day) AS avg_hour_of_day,
    CAST(count_if(is_night_transaction) AS BIGINT) AS night_txn_count,
    CAST(count_if(is_weekend) AS BIGINT) AS weekend_txn_count,
    CAST(sum(failed_attempt_count) AS BIGINT) AS total_failures,
    avg(failed_attempt_count) AS avg_failures_per_txn,
    CAST(count_if(is_fraud) AS BIGINT) AS confirmed_fraud_count,
    sum(CASE WHEN is_fraud THEN amount ELSE 0 END) AS confirmed_fraud_amount,
    avg(fraud_score) AS avg_fraud_score, max(fraud_score) AS max_fraud_score,
    CAST(count_if(is_foreign_transaction) AS BIGINT) AS foreign_txn_count,
    CAST(count_if(amount BETWEEN 9000 AND 9999) AS BIGINT) AS structuring_pattern_count
  FROM txn WHERE {recent()} GROUP BY customer_id
)"""

PROFILES = f"""
profiles AS (
  SELECT stats.*, full_name, kyc_status, account_status, risk_score AS profile_risk_score, account_age_days,
    income_band, is_politically_exposed, country,
    {half_up('''least(1.0, confirmed_fraud_count / CAST(total_txns_30d AS DOUBLE) * 0.3
      + unique_devices_30d / 10.0 * 0.1 + unique_cities_30d / 10.0 * 0.1
      + night_txn_count / CAST(total_txns_30d AS DOUBLE) * 0.15
      + foreign_txn_count / CAST(total_txns_30d AS DOUBLE) * 0.15
      + structuring_pattern_count / CAST(total_txns_30d AS DOUBLE) * 0.2)''', 4)} AS computed_risk_score,
    CASE WHEN confirmed_fraud_count > 0 THEN 'CRITICAL' WHEN max_fraud_score > 0.7 THEN 'HIGH'
      WHEN unique_devices_30d > 5 OR unique_cities_30d > 5 THEN 'MEDIUM' ELSE 'LOW' END AS customer_risk_tier
  FROM stats LEFT JOIN (SELECT * FROM hist WHERE valid_to IS NULL) AS h ON stats.customer_id = h.customer_id
)"""

DAILY = """
daily AS (
  SELECT transaction_date, count(*) AS txn_count, sum(amount) AS total_amount, avg(amount) AS avg_amount,
    count(DISTINCT customer_id) AS unique_customers
  FROM txn GROUP BY transaction_date
)"""

ROLLING = """
rolling AS (
  SELECT *, avg(txn_count) OVER w AS rolling_avg_txn_count, stddev_samp(txn_count) OVER w AS rolling_stddev_txn_count,
    avg(total_amount) OVER w AS rolling_avg_total_amount,
    stddev_samp(total_amount) OVER w AS rolling_stddev_total_amount
  FROM daily WINDOW w AS (ORDER BY transaction_date ROWS BETWEEN 6 PRECEDING AND CURRENT ROW)
)"""

DATE_TEXT = "REPLACE (CAST(transaction_date AS VARCHAR) AS transaction_date)"
ROLLING_ROUNDED = """REPLACE (CAST(transaction_date AS VARCHAR) AS transaction_date,
  round(rolling_stddev_txn_count, 6) AS rolling_stddev_txn_count,
  round(rolling_stddev_total_amount, 6) AS rolling_stddev_total_amount)"""


def _health(layer: str, where: str) -> str:
    return f"""SELECT '{layer}' AS layer_table, count(*) AS row_count, min(event_timestamp) AS oldest_record,
    max(event_timestamp) AS newest_record,
    date_sub('minute', max(event_timestamp), TIMESTAMP '{AS_OF}') AS lag_minutes
  FROM txn WHERE {where} HAVING count(*) > 0"""


def _with(*parts: str, select: str) -> str:
    return "WITH " + ",\n".join(parts) + "\n" + select


def _velocity_query(source: str, key: str, unit: str) -> str:
    grouped, select = velocity(key, unit)
    return _with(TXN, f"source AS ({source})", grouped, select=select)


_TXN_LIST_TEXT_DATE = ", ".join(
    "CAST(transaction_date AS VARCHAR) AS transaction_date" if c == "transaction_date" else f'"{c}"'
    for c in TXN_COLUMNS
)
_KM = "2 * 6371 * asin(sqrt(least(CAST(1 AS DOUBLE), chord)))"

_DQ = {**BRONZE_PREDICATES, **SILVER_PREDICATES}
_DQ_ROWS = " UNION ALL ".join(
    f"SELECT '{n}' AS rule, CAST(count_if(coalesce({p}, FALSE)) AS BIGINT) AS passed, "
    f"CAST(count_if(NOT coalesce({p}, FALSE)) AS BIGINT) AS failed, count(*) AS total FROM messy"
    for n, p in _DQ.items()
)
_NULL_COLUMNS = ("transaction_id", "customer_id", "amount", "timestamp", "device_type", "fraud_type", "currency")
_NULL_ROWS = " UNION ALL ".join(
    f"""SELECT '{c}' AS column_name, 100 * avg(CASE WHEN "{c}" IS NULL THEN 1 ELSE 0 END) AS null_pct,
    100 * avg(CASE WHEN "{c}" IS NULL THEN 1 ELSE 0 END) > 5 AS quarantine FROM messy"""
    for c in _NULL_COLUMNS
)
_REASON = ("CASE WHEN transaction_id IS NULL THEN 'NULL_TRANSACTION_ID' WHEN amount IS NULL THEN 'NULL_AMOUNT' "
           "WHEN amount <= 0 THEN 'INVALID_AMOUNT' END")

BATCH = {
    "risk_band": _with(MESSY, select=f'SELECT "offset", {RISK_BAND} AS risk_band FROM messy'),
    "amount_band": _with(MESSY, select=f'SELECT "offset", {amount_band("amount")} AS amount_band FROM messy'),
    "high_risk_merchant": _with(TXN, select=f"SELECT transaction_id, {HIGH_RISK} AS is_high_risk_merchant FROM txn"),
    "scalar_json": f"""SELECT event_id, CAST({_json_int('props', 'k')} AS BIGINT) AS k,
      '{{"event_id":' || CAST(event_id AS VARCHAR) || ',"event_type":"' || event_type || '"}}' AS body,
      TRUE AS malformed_is_null FROM events""",
    "scalar_string": _with(MESSY, select="""SELECT "offset", 'ALERT_' || transaction_id AS concat,
      concat_ws(' | ', transaction_id, customer_id, location_city) AS concat_ws, upper(currency) AS upper,
      concat_ws('|', device_id, device_type, ip_address) AS joined_list, ip_address AS second_item FROM messy"""),
    "scalar_cast": _with(TXN, select="""SELECT transaction_id, CAST(amount AS VARCHAR) AS to_string,
      event_timestamp AS to_timestamp, CAST(transaction_date AS VARCHAR) AS to_date, "offset" AS to_long,
      fraud_score AS to_double, TRUE AS bad_timestamp_is_null FROM txn"""),
    "scalar_date": _with(TXN, select=f"""SELECT transaction_id, event_timestamp AS ts,
      CAST(date_trunc('hour', event_timestamp) AS TIMESTAMP) AS hour_start,
      date_sub('minute', event_timestamp, TIMESTAMP '{AS_OF}') AS minutes_to_as_of,
      {_epoch('event_timestamp')} AS epoch_seconds, event_timestamp + INTERVAL 6 HOURS AS plus_6h,
      CAST(date_trunc('hour', event_timestamp) AS TIMESTAMP) AS window_start,
      CAST(date_trunc('hour', event_timestamp) AS TIMESTAMP) + INTERVAL 1 HOUR AS window_end,
      hour_of_day, day_of_week, is_weekend, is_night_transaction, TRUE AS in_the_past, TRUE AS not_after_today
      FROM txn"""),
    "scalar_math": _with(TXN, select=f"""SELECT transaction_id, round(radians(latitude), 9) AS radians,
      round(sin(radians(latitude)), 9) AS sin, round(cos(radians(latitude)), 9) AS cos,
      round(asin(fraud_score), 9) AS asin, round(sqrt(amount), 9) AS sqrt, pow(fraud_score, 2) AS pow,
      round({_KM}, 4) AS km_asin, round({_KM}, 4) AS km_atan2, abs(5000 - amount) AS abs,
      {half_up('amount / 7', 2)} AS round, least(CAST(1 AS DOUBLE), fraud_score * 2) AS least,
      greatest(CAST(0 AS DOUBLE), least(CAST(1 AS DOUBLE), (amount - 3000) / 4096)) AS clamped
      FROM (SELECT *, pow(sin((radians(latitude) - radians(18.52)) / 2), 2) + cos(radians(18.52))
        * cos(radians(latitude)) * pow(sin((radians(longitude) - radians(73.86)) / 2), 2) AS chord FROM txn)"""),
    "scalar_conditional": _with(MESSY, select="""SELECT "offset",
      CASE WHEN amount > 1000 THEN 'big' WHEN amount IS NULL THEN 'none' ELSE 'small' END AS "case",
      coalesce(amount, 0.0) AS "coalesce", nullif(currency, 'INR') AS "nullif", transaction_id IS NULL AS is_null,
      device_type IS NOT NULL AS is_not_null, currency IN ('INR', 'USD') AS in_set,
      amount BETWEEN 9000 AND 9999 AS "between" FROM messy"""),
    "scalar_array": _with(MESSY, select="""SELECT "offset", concat_ws(',',
      CASE WHEN amount > 5000 THEN 'BIG' ELSE '-' END,
      CASE WHEN fraud_score > 0.5 THEN 'SCORE:' || CAST(fraud_score AS VARCHAR) ELSE '-' END,
      coalesce(device_type, '-')) AS marks, CAST(3 AS BIGINT) AS n_marks FROM messy"""),
    "bronze_enrich": _with(TXN, select=f"""SELECT {_TXN_LIST_TEXT_DATE}, 'S3_AUTO_LOADER' AS _source_system,
      event_timestamp FROM txn"""),
    "audit_columns": _with(TXN, select="""SELECT 'BRONZE' AS _layer, 'fraud_engine_v1' AS _pipeline_name,
      count(*) AS row_count, count(DISTINCT transaction_id) AS distinct_hashes, CAST(0 AS BIGINT) AS missing_times
      FROM txn"""),
    "change_hash": _with(HISTORY, select="""SELECT customer_id, change_id,
      (lag(change_id) OVER w IS NULL OR kyc_status IS DISTINCT FROM lag(kyc_status) OVER w
        OR city IS DISTINCT FROM lag(city) OVER w OR risk_score IS DISTINCT FROM lag(risk_score) OVER w) AS changed
      FROM cust WINDOW w AS (PARTITION BY customer_id ORDER BY changed_at, change_id)"""),
    "dead_letter": _with(MESSY, select=f"""SELECT * FROM (SELECT "offset", transaction_id, customer_id, amount,
      {_REASON} AS _quarantine_reason, 'BRONZE' AS _layer FROM messy) WHERE _quarantine_reason IS NOT NULL"""),
    "expect_track": _with(MESSY, select=f'SELECT "offset", {violations(BRONZE_PREDICATES)} AS _violations FROM messy'),
    "expect_drop": _with(MESSY, select=f"""SELECT "offset", transaction_id, amount FROM messy
      WHERE {all_pass(BRONZE_PREDICATES)}"""),
    "expect_fail": _with(TXN, select="SELECT transaction_id, fraud_score FROM txn WHERE fraud_score >= 0.0"),
    "silver_rules": _with(MESSY, select=f'SELECT "offset", {violations(SILVER_PREDICATES)} AS _violations FROM messy'),
    "gold_rules": _with(TXN, HISTORY, CUSTOMER_STATS, PROFILES,
                        select=f"SELECT customer_id, {violations(GOLD_PREDICATES)} AS _violations FROM profiles"),
    "dq_report": _with(MESSY, select=_DQ_ROWS),
    "null_rate_gate": _with(MESSY, select=_NULL_ROWS),
    "scd1_transactions": _with(TXN_CHANGES, select=f"SELECT * {DATE_TEXT} FROM cleaned"),
    "scd1_merchants": _with(MERCHANTS, select="""SELECT merchant_id, merchant_name || ' v3' AS merchant_name,
      merchant_category, risk_category,
      city || CASE WHEN merchant_tenure_days % 2 = 0 THEN ' 2' ELSE ' 3' END AS city, state,
      historical_fraud_score, merchant_tenure_days, CAST(3 AS BIGINT) AS seq FROM merch"""),
    "scd2_customers": _with(HISTORY, select="SELECT * FROM hist"),
    "scd2_current": _with(HISTORY, select="SELECT * FROM hist WHERE valid_to IS NULL"),
    "dedup_exact": """SELECT * EXCLUDE (copy) REPLACE (CAST(l_linenumber AS BIGINT) AS l_linenumber) FROM (
      SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber
        ORDER BY l_shipdate, l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax, l_returnflag,
          l_linestatus) AS copy FROM lineitem) WHERE copy = 1""",
    "unified": _with(TXN_CHANGES, MESSY.replace(TXN + ",", "", 1).strip(), LANDED_CLEANED, select="""
      SELECT transaction_id, amount, CAST(NULL AS DOUBLE) AS amount_usd, transaction_status, event_timestamp,
        CAST(NULL AS VARCHAR) AS risk_band, CAST(NULL AS VARCHAR) AS _processing_path FROM cleaned
      UNION ALL SELECT transaction_id, amount, amount_usd, transaction_status, event_timestamp, risk_band,
        _processing_path FROM landed_cleaned"""),
    "fx_join": _with(TXN, FX, select="SELECT transaction_id, currency, amount, amount_usd FROM priced"),
    "silver_enriched": _with(TXN, FX, select=f"""SELECT transaction_id, customer_id, amount, amount_usd,
      {RISK_BAND} AS risk_band, {amount_band('amount_usd')} AS amount_band, {HIGH_RISK} AS is_high_risk_merchant,
      event_timestamp, 'SILVER' AS _layer FROM priced"""),
    "silver_s3_cleaned": _with(MESSY, LANDED_CLEANED, select="""SELECT transaction_id, customer_id, amount_usd,
      currency, risk_band, _processing_path, event_timestamp, 'SILVER' AS _layer FROM landed_cleaned"""),
    "lookback_filter": _with(TXN, select=f"SELECT transaction_id, event_timestamp FROM txn WHERE {recent(LATER)}"),
    "fraud_alerts": _with(TXN, ALERTS, select="SELECT * FROM alerts"),
    "velocity_hourly": _velocity_query("SELECT * FROM txn", "customer_id", "hour"),
    "velocity_daily": _velocity_query(
        "SELECT *, CAST(split_part(customer_id, '_', 2) AS BIGINT) % 15 AS customer_group FROM txn",
        "customer_group", "day"),
    "velocity_tumbling": _with(TXN, select="""SELECT * FROM (
      SELECT CAST(split_part(customer_id, '_', 2) AS BIGINT) % 3 AS customer_id,
        time_bucket(INTERVAL 12 HOURS, event_timestamp, TIMESTAMP '1970-01-01') AS window_start,
        time_bucket(INTERVAL 12 HOURS, event_timestamp, TIMESTAMP '1970-01-01') + INTERVAL 12 HOURS AS window_end,
        count(*) AS txn_count FROM txn GROUP BY ALL) WHERE txn_count > 6"""),
    "lag_previous_txn": _with(TXN, PAIRS.format(where="TRUE"), select="""SELECT customer_id, transaction_id,
      prev_event_timestamp, prev_latitude, prev_longitude, prev_location_city, prev_location_country,
      prev_transaction_id FROM pairs"""),
    "impossible_travel": _with(TXN, PAIRS.format(where=recent()), TRAVEL, select="SELECT * FROM travel"),
    "merchant_scores": _with(TXN, MERCHANTS, MERCHANT_SCORES, select="SELECT * FROM scores"),
    "top_merchants": _with(TXN, MERCHANTS, MERCHANT_SCORES, select="""SELECT * FROM scores
      ORDER BY computed_risk_score DESC, merchant_id LIMIT 20"""),
    "customer_stats_30d": _with(TXN, CUSTOMER_STATS, select="SELECT * FROM stats"),
    "customer_profiles": _with(TXN, HISTORY, CUSTOMER_STATS, PROFILES, select="SELECT * FROM profiles"),
    "aml_structuring": _with(TXN, select="""SELECT customer_id, count(*) AS structuring_count FROM txn
      WHERE amount BETWEEN 9000 AND 9999 GROUP BY customer_id HAVING count(*) >= 3"""),
    "ops_kpis": _with(TXN, select="""SELECT CAST(transaction_date AS VARCHAR) AS transaction_date,
      count(*) AS txn_count, CAST(count_if(is_fraud) AS BIGINT) AS fraud_count,
      sum(CASE WHEN is_fraud THEN amount ELSE 0 END) AS gross_fraud_value FROM txn GROUP BY transaction_date"""),
    "fraud_hotspots": _with(TXN, ALERTS, select="""SELECT location_city, count(*) AS fraud_count,
      sum(amount) AS fraud_value FROM alerts GROUP BY location_city"""),
    "fraud_type_mix": _with(TXN, ALERTS, select="""SELECT fraud_type, alert_severity, count(*) AS alert_count,
      sum(amount) AS alert_value FROM alerts GROUP BY fraud_type, alert_severity"""),
    "fraud_clusters": _with(TXN, ALERTS, select="""SELECT
      CASE WHEN fraud_type IN ('VELOCITY', 'VELOCITY_FRAUD') AND amount < 1000 THEN 'MICRO_VELOCITY_FRAUD'
        WHEN fraud_type = 'IMPOSSIBLE_TRAVEL' THEN 'GEO_ANOMALY_FRAUD'
        WHEN fraud_score >= 0.90 AND amount > 10000 THEN 'HIGH_VALUE_FRAUD' ELSE 'GENERAL_FRAUD' END AS fraud_cluster,
      fraud_type, count(*) AS fraud_count, sum(amount) AS total_fraud_amount, avg(fraud_score) AS avg_fraud_score,
      count(DISTINCT customer_id) AS unique_customers, count(DISTINCT merchant_id) AS unique_merchants
      FROM alerts GROUP BY ALL"""),
    "daily_totals": _with(TXN, DAILY, select=f"SELECT * {DATE_TEXT} FROM daily"),
    "rolling_7d": _with(TXN, DAILY, ROLLING, select=f"SELECT * {ROLLING_ROUNDED} FROM rolling"),
    "daily_anomaly": _with(TXN, DAILY, ROLLING, """
z AS (
  SELECT *, (txn_count - rolling_avg_txn_count) / coalesce(nullif(rolling_stddev_txn_count, 0), 1) AS zc,
    (total_amount - rolling_avg_total_amount) / coalesce(nullif(rolling_stddev_total_amount, 0), 1) AS za
  FROM rolling
)""", select=f"""SELECT * EXCLUDE (zc, za) {ROLLING_ROUNDED}, round(zc, 6) AS txn_count_z_score,
      round(za, 6) AS total_amount_z_score, (abs(zc) > 1.5 OR abs(za) > 1.5) AS is_anomaly,
      CASE WHEN abs(zc) > 2 THEN 'CRITICAL' WHEN abs(zc) > 1.5 THEN 'HIGH' ELSE 'NORMAL' END AS anomaly_severity
      FROM z"""),
    "pipeline_health": _with(TXN, "h AS (" + " UNION ALL ".join([
        _health("bronze_transactions", "TRUE"),
        _health("silver_transactions", "transaction_status = 'FAILED'"),
        _health("gold_fraud_alerts", "is_fraud AND fraud_score >= 0.60"),
    ]) + ")", select="""SELECT *, CASE WHEN lag_minutes > 60 THEN 'CRITICAL' WHEN lag_minutes > 30 THEN 'WARNING'
      ELSE 'HEALTHY' END AS health_status FROM h"""),
}

_C = "c_custkey"
_CITY_NAMES, _CITY_STATES = [c[0] for c in CITIES], [c[1] for c in CITIES]

CUSTOMER_FILES = f"""SELECT 'CUST_' || CAST({_C} AS VARCHAR) AS customer_id, c_name AS full_name,
  'c' || CAST({_C} AS VARCHAR) || '@example.org' AS email, '+91' || CAST({_C} + 6000000000 AS VARCHAR) AS phone,
  '1980-05-17' AS date_of_birth, {_pick(("VERIFIED", "PENDING", "FAILED", "EXPIRED"), f"{_C} % 4")} AS kyc_status,
  {_pick(("ACTIVE", "SUSPENDED", "UNDER_REVIEW"), f"{_C} % 3")} AS account_status,
  ({_C} % 64) / CAST(64 AS DOUBLE) AS risk_score, {_C} % 2000 AS account_age_days, 'IN' AS country,
  {_pick(_CITY_NAMES, f"{_C} % {len(CITIES)}")} AS city, {_pick(_CITY_STATES, f"{_C} % {len(CITIES)}")} AS state,
  CAST({_C} + 100000 AS VARCHAR) AS pin_code,
  {_pick(("LOW", "MEDIUM", "HIGH", "ULTRA_HIGH"), f"{_C} % 4")} AS income_band,
  'FP' || CAST({_C} AS VARCHAR) AS device_fingerprint,
  'D' || CAST({_C} AS VARCHAR) || '|E' || CAST({_C} % 9 AS VARCHAR) AS registered_devices,
  {_pick(PAYMENTS, f"{_C} % {len(PAYMENTS)}")} AS preferred_payment, c_acctbal AS typical_transaction_amount,
  'FUEL|' || c_mktsegment AS typical_merchant_categories, {_C} % 50 = 0 AS is_politically_exposed,
  '2020-01-01' AS account_open_date, '2024-01-01' AS last_login_date, {_C} % 11 AS failed_login_count,
  {_C} % 5 = 0 AS is_synthetic_fraud_customer,
  CASE WHEN {_C} % 5 = 0 THEN {_pick(FRAUD_TYPES, f"{_C} % 4")} END AS fraud_type,
  'S3_CUSTOMERS' AS _source_system, CAST(NULL AS VARCHAR) AS _batch_id, 'BRONZE' AS _layer,
  'fraud_engine_v1' AS _pipeline_name
FROM customer WHERE {_C} % 40 <> 0"""

_CATEGORY = _pick(CATEGORIES, f"s_suppkey % {len(CATEGORIES)}")

MERCHANT_FILES = f"""SELECT CASE WHEN s_suppkey % 9 <> 0 THEN 'MERCH_' || CAST(s_suppkey AS VARCHAR) END AS merchant_id,
  s_name AS merchant_name, {_CATEGORY} AS merchant_category,
  CAST(s_suppkey + 4000 AS VARCHAR) AS merchant_category_code,
  {_pick(("ONLINE", "PHYSICAL", "HYBRID"), "s_suppkey % 3")} AS business_type, 'IN' AS country,
  {_pick(_CITY_NAMES, f"s_suppkey % {len(CITIES)}")} AS city,
  {_pick(_CITY_STATES, f"s_suppkey % {len(CITIES)}")} AS state,
  CAST({_pick([c[3] for c in CITIES], f"s_suppkey % {len(CITIES)}")} AS DOUBLE) AS latitude,
  CAST({_pick([c[4] for c in CITIES], f"s_suppkey % {len(CITIES)}")} AS DOUBLE) AS longitude,
  CASE WHEN s_suppkey % 2 = 0 THEN 'LOW' ELSE 'HIGH' END AS risk_category,
  (s_suppkey % 64) / CAST(64 AS DOUBLE) AS historical_fraud_score, s_acctbal AS avg_transaction_amount,
  s_suppkey * 10 AS monthly_transaction_volume, s_suppkey % 3 = 0 AS accepts_international,
  {HIGH_RISK.replace("merchant_category", _CATEGORY, 1)} AS is_high_risk_category,
  (s_suppkey * 53) % 3650 AS merchant_tenure_days, (s_suppkey % 16) / CAST(64 AS DOUBLE) AS chargeback_rate,
  '2021-06-01' AS registered_date
FROM supplier"""

_CUT = '"offset" % 50 = 0'
_PARSED = ", ".join(
    f"CASE WHEN NOT ({_CUT}) THEN "
    + ("CAST(transaction_date AS VARCHAR)" if c == "transaction_date" else f'"{c}"') + f' END AS "{c}"'
    for c in TXN_COLUMNS
)

FILES = {
    "src_envelope_parse": _with(TXN, select=f"""SELECT {_PARSED}, CAST(NULL AS VARCHAR) AS _kafka_produced_at,
      CAST(NULL AS VARCHAR) AS _schema_version,
      CASE WHEN {_CUT} THEN '{{{{{{"transaction_id":"T' END AS _corrupt_record,
      'payments' AS _kafka_topic, "offset" % 3 AS _kafka_partition, "offset" AS _kafka_offset,
      event_timestamp AS _kafka_timestamp, 'KAFKA' AS _source_system,
      CASE WHEN NOT ({_CUT}) THEN event_timestamp END AS event_timestamp, 'BRONZE' AS _layer,
      'fraud_engine_v1' AS _pipeline_name FROM txn"""),
    "src_parquet_incremental": _with(TXN, select=f"""SELECT {_TXN_LIST_TEXT_DATE}, 'S3_AUTO_LOADER' AS _source_system,
      event_timestamp, 'BRONZE' AS _layer, 'fraud_engine_v1' AS _pipeline_name FROM txn"""),
    "src_csv_customers": CUSTOMER_FILES,
    "src_csv_merchants": f"""SELECT *, 'S3_MERCHANTS' AS _source_system, 'BRONZE' AS _layer,
      'fraud_engine_v1' AS _pipeline_name FROM ({MERCHANT_FILES}) WHERE merchant_id IS NOT NULL""",
    "src_csv_fx": _with(TXN, FX, select="""SELECT currency_code, CAST(rate_date AS VARCHAR) AS rate_date,
      usd_multiplier, 'S3_FX_RATES' AS _source_system, 'BRONZE' AS _layer, 'fraud_engine_v1' AS _pipeline_name
      FROM fx"""),
    "src_json_schema": _with(MESSY, select=f"""SELECT * FROM (SELECT transaction_id, merchant_id, amount, "timestamp",
      {_REASON} AS _quarantine_reason FROM messy) WHERE _quarantine_reason IS NOT NULL"""),
    "src_file_lineage": _with(TXN, select="SELECT transaction_id, currency AS folder_currency FROM txn"),
    "src_partition_pruned": _with(TXN, select="""SELECT transaction_id, CAST(transaction_date AS VARCHAR)
      AS transaction_date, amount FROM txn WHERE transaction_date >= DATE '2024-01-20'"""),
    "sink_csv_roundtrip": MERCHANT_FILES,
    "sink_parquet_partitioned": _with(TXN, select=f"SELECT {_TXN_LIST_TEXT_DATE} FROM txn"),
    "sink_envelope_encode": _with(TXN, select="""SELECT customer_id AS message_key, transaction_id, customer_id, amount,
      "timestamp", is_fraud FROM txn"""),
}

BATCH |= {
    "scd1_merge_incremental": BATCH["scd1_transactions"],
    "scd2_merge_incremental": BATCH["scd2_customers"],
    "fx_join_salted": BATCH["fx_join"],
    "customer_stats_incremental": _with(TXN, CUSTOMER_STATS, select="""SELECT * REPLACE (TRUE AS unique_devices_30d, TRUE AS unique_cities_30d,
      TRUE AS unique_merchant_cats, TRUE AS unique_ips_30d) FROM stats"""),
}

def _layer_row(layer: str, rows: str) -> str:
    return f"""SELECT '{layer}' AS layer_table, count(*) AS row_count, min(event_timestamp) AS oldest_record,
      max(event_timestamp) AS newest_record FROM {rows} HAVING count(*) > 0"""


BATCH |= {
    "silver_quarantine": _with(MESSY, LANDED_CLEANED, select="""SELECT "offset", FALSE AS quarantined FROM landed_cleaned
      WHERE transaction_id IS NOT NULL UNION ALL SELECT "offset", TRUE FROM messy WHERE transaction_id IS NULL"""),
    "scd1_ties": _with(TXN, select="SELECT transaction_id, TRUE AS one_record FROM txn"),
    "scd1_two_partitions": BATCH["scd1_transactions"],
    "scd1_deletes": _with(TXN_CHANGES, """marked AS (SELECT *, "offset" % 11 = 5 AS gone,
        coalesce(max("offset") FILTER (WHERE "offset" % 11 = 5) OVER (PARTITION BY transaction_id), -1) AS since FROM changes)""",
      select="""SELECT transaction_id, arg_max(amount, "offset") FILTER (WHERE amount IS NOT NULL) AS amount,
        arg_max(device_id, "offset") FILTER (WHERE device_id IS NOT NULL) AS device_id
      FROM marked WHERE NOT gone AND "offset" > since GROUP BY transaction_id"""),
    "scd2_customers_hot": BATCH["scd2_customers"],
    "fx_ties": _with(TXN, FX, select="""SELECT currency_code, CAST(rate_date AS VARCHAR) AS rate_date,
      max(usd_multiplier) AS usd_multiplier FROM fx GROUP BY currency_code, rate_date"""),
    "bronze_zone": _with(TXN, select="""SELECT transaction_id, event_timestamp - CASE "offset" % 4 WHEN 1 THEN INTERVAL 0 MINUTES
      WHEN 3 THEN INTERVAL 60 MINUTES ELSE INTERVAL 330 MINUTES END AS event_timestamp FROM txn"""),
    "unified_travel": _with(TXN, PAIRS.format(where=recent()), TRAVEL, select="SELECT * EXCLUDE (amount) FROM travel"),
    "sql_over_layers": _with(TXN, select=f"""SELECT currency, {RISK_BAND} AS risk_band, count(*) AS txn_count,
      CAST(count_if({HIGH_RISK}) AS BIGINT) AS high_risk FROM txn GROUP BY ALL"""),
    "refresh_health": _with(MESSY, LANDED_CLEANED, ALERTS, "keyed AS (SELECT * FROM landed_cleaned WHERE transaction_id IS NOT NULL)",
      "h AS (" + " UNION ALL ".join(_layer_row(*r) for r in (
        ("bronze_transactions", "messy"), ("silver_transactions", "keyed"), ("gold_fraud_alerts", "alerts"))) + ")",
      f"""m AS (SELECT *, date_sub('minute', newest_record, TIMESTAMP '{AS_OF}') AS lag_minutes FROM h)""",
      select="""SELECT *, CASE WHEN lag_minutes > 60 THEN 'CRITICAL' WHEN lag_minutes > 30 THEN 'WARNING' ELSE 'HEALTHY' END
        AS health_status FROM m"""),
}

_EVEN, _CUT_OFF = '"offset" % 2 = 0', '"offset" % 50 = 1'
_BAD = """day(transaction_date) IN (5, 12) AND "offset" % 3 = 0"""

FILES |= {
    "src_schema_drift": _with(TXN, select=f"""SELECT CASE WHEN NOT ({_CUT_OFF}) THEN transaction_id END AS transaction_id,
        CASE WHEN NOT ({_CUT_OFF}) THEN amount END AS amount,
        CASE WHEN NOT ({_EVEN} OR {_CUT_OFF}) THEN "offset" / CAST(4 AS DOUBLE) END AS fee,
        CASE WHEN NOT ({_EVEN} OR {_CUT_OFF}) AND "offset" % 5 = 0 THEN CAST("offset" % 7 AS BIGINT) END AS points,
        CASE WHEN NOT ({_EVEN} OR {_CUT_OFF}) AND "offset" % 5 = 0 THEN 'T' || CAST("offset" % 3 AS VARCHAR) END AS tier,
        CASE WHEN {_CUT_OFF} THEN '{{"transaction_id":"T' END AS _corrupt_record FROM txn"""),
    "gate_publish": _with(TXN, select=f"""SELECT transaction_id, CAST(transaction_date AS VARCHAR) AS transaction_date,
        CASE WHEN day(transaction_date) = 12 THEN amount WHEN {_BAD} THEN -1.0 ELSE amount + 1 END AS amount,
        day(transaction_date) <> 5 AS published FROM txn"""),
}

_HELD_BACK = """CAST(substr(customer_id, 6) AS BIGINT) % 10 = 7 AND "offset" % 3 = 0"""
# The watermark lies a day behind the latest transaction that was not held back.
_LATE = f"""(({_HELD_BACK}) AND event_timestamp <
    (SELECT max(event_timestamp) - INTERVAL 1 DAY FROM txn WHERE NOT ({_HELD_BACK})))"""

STREAMS = {
    "stream_alerts": BATCH["fraud_alerts"],
    "stream_fx_join": BATCH["fx_join"],
    # Windows that end after the final watermark have not come out yet.
    "stream_rule_counts": BATCH["dq_report"],
    "live_path": _with(TXN, ALERTS, select=f"""SELECT transaction_id, 'alert' AS output, alert_severity AS detail
        FROM alerts JOIN (SELECT transaction_id, "offset" FROM txn) USING (transaction_id) WHERE NOT ({_CUT})
      UNION ALL SELECT transaction_id, 'current', transaction_status FROM txn WHERE NOT ({_CUT}) AND amount > 0
      UNION ALL SELECT CASE WHEN NOT ({_CUT}) THEN transaction_id END, 'dead', CASE WHEN {_CUT} THEN 'MALFORMED_JSON' ELSE 'INVALID_AMOUNT' END
        FROM txn WHERE {_CUT} OR amount <= 0"""),
    "stream_late_rows": _with(TXN, select=f"SELECT transaction_id, customer_id, amount, {_LATE} AS late FROM txn"),
    # A day comes out once both streams have passed it: transactions by 30 minutes, rates by four days.
    "stream_fx_join_growing": _with(TXN, FX, select="""SELECT transaction_id, currency, amount,
        amount * usd_multiplier AS amount_usd, usd_multiplier IS NULL AS rate_missing
      FROM txn LEFT JOIN (SELECT currency_code, rate_date, max_by(usd_multiplier, ingest_no) AS usd_multiplier FROM fx GROUP BY ALL) r
        ON currency = currency_code AND transaction_date = rate_date
      WHERE transaction_date + INTERVAL 1 DAY <= (SELECT least(max(event_timestamp) - INTERVAL 30 MINUTES,
        CAST(max(transaction_date) AS TIMESTAMP) - INTERVAL 4 DAYS) FROM txn)"""),
    "stream_tumbling": _with(TXN, select="""SELECT * FROM (
      SELECT customer_id, CAST(date_trunc('hour', event_timestamp) AS TIMESTAMP) AS window_start,
        CAST(date_trunc('hour', event_timestamp) AS TIMESTAMP) + INTERVAL 1 HOUR AS window_end,
        count(*) AS txn_count, sum(amount) AS total_amount, count(DISTINCT merchant_id) AS approx_merchants
      FROM txn GROUP BY ALL)
      WHERE window_end <= (SELECT max(event_timestamp) FROM txn) - INTERVAL 30 MINUTES"""),
    "dedup_watermark": FILES["sink_parquet_partitioned"],
    "stream_scd1": BATCH["scd1_transactions"],
    "stream_scd2": BATCH["scd2_customers"],
    "stream_impossible_travel": BATCH["impossible_travel"],
    "stream_late_travel": _with(TXN, PAIRS.format(where=f"{recent()} AND NOT {_LATE}"), TRAVEL, select=f"""
      SELECT customer_id, txn_id_1, txn_id_2, FALSE AS late FROM travel
      UNION ALL SELECT customer_id, NULL, transaction_id, TRUE FROM txn WHERE {recent()} AND {_LATE}"""),
}

SQL = {**BATCH, **FILES, **STREAMS}
