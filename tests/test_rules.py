"""Risk rules on small inputs with known answers."""

import math
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from conftest import SF
from veriflux.functions import bands, geo, times
from veriflux.operators import cdc
from veriflux.operators.audit import type_event_time
from veriflux.params import RiskParams
from veriflux.plans import bronze, gold, monitoring, silver
from workload import inputs

AS_OF = RiskParams(as_of="2024-01-31 00:00:00")
KM_PER_DEGREE = 6371 * math.pi / 180  # along a meridian

TXN = """transaction_id string, customer_id string, merchant_id string, amount double, currency string,
    transaction_status string, location_city string, location_country string, latitude double, longitude double,
    payment_method string, device_id string, device_type string, merchant_category string, ip_address string,
    is_fraud boolean, fraud_type string, fraud_score double, hour_of_day int, is_weekend boolean,
    is_night_transaction boolean, is_foreign_transaction boolean, failed_attempt_count int, event_ts string,
    timestamp string"""
DEFAULTS = dict(
    transaction_id="T1", customer_id="C1", merchant_id="M1", amount=100.0, currency="INR",
    transaction_status="SUCCESS", location_city="Pune", location_country="IN", latitude=18.5, longitude=73.9,
    payment_method="UPI", device_id="D1", device_type="MOBILE", merchant_category="FUEL", ip_address="10.0.0.1",
    is_fraud=False, fraud_type=None, fraud_score=0.1, hour_of_day=10, is_weekend=False,
    is_night_transaction=False, is_foreign_transaction=False, failed_attempt_count=0,
    event_ts="2024-01-15 10:00:00", timestamp="2024-01-15T10:00:00",
)


def txns(spark, *rows):
    names = [part.split()[0] for part in TXN.split(",")]
    data = [tuple({**DEFAULTS, **row}[n] for n in names) for row in rows]
    ts = F.col("event_ts").cast("timestamp")
    return spark.createDataFrame(data, TXN).withColumns({
        "event_timestamp": ts, "transaction_date": ts.cast("date"),
    }).drop("event_ts")


def values(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=str)


# ---- functions ----------------------------------------------------------------------------------


@pytest.mark.parametrize("score, band", [
    (0.8, "CRITICAL"), (0.79, "HIGH"), (0.6, "HIGH"), (0.4, "MEDIUM"), (0.39, "LOW"), (None, "LOW"),
])
def test_risk_band_edges_and_null(spark, score, band):
    df = spark.createDataFrame([(score,)], "s double")
    assert df.select(bands.risk_band(F.col("s"))).first()[0] == band


@pytest.mark.parametrize("amount, band", [
    (99.99, "MICRO (<100)"), (100.0, "SMALL (100-1K)"), (1000.0, "MEDIUM (1K-10K)"), (10000.0, "LARGE (10K-100K)"),
    (100000.0, "VERY_LARGE (>100K)"), (None, "VERY_LARGE (>100K)"),
])
def test_amount_band_edges_and_null(spark, amount, band):
    df = spark.createDataFrame([(amount,)], "a double")
    assert df.select(bands.amount_band(F.col("a"))).first()[0] == band


@pytest.mark.parametrize("n, score", [(31, 1.0), (30, 0.9), (21, 0.9), (16, 0.7), (11, 0.5), (10, 0.2)])
def test_velocity_score(spark, n, score):
    assert spark.range(1).select(bands.velocity_score(F.lit(n))).first()[0] == score


def test_antipodal_distance_is_a_number(spark):
    points = spark.createDataFrame([(a / 7, b / 3) for a in range(-600, 600, 7) for b in range(0, 500, 11)],
                                   "lat double, lon double").withColumns({"lat2": -F.col("lat"),
                                                                          "lon2": F.col("lon") + 180})
    for distance in (geo.haversine_km, geo.haversine_km_atan2):
        km = distance(*[F.col(c) for c in ("lat", "lon", "lat2", "lon2")])
        low, high, bad = points.select(km.alias("km")).agg(
            F.min("km"), F.max("km"), F.count_if(F.isnan("km") | F.col("km").isNull())).first()
        assert bad == 0 and 20015.0 < low <= high < 20015.2


def test_distance_needs_both_points(spark):
    row = spark.range(1).select(geo.haversine_km(F.lit(None).cast("double"), F.lit(1.0), F.lit(2.0), F.lit(3.0)))
    assert row.first()[0] is None


def test_gap_is_decimal_with_six_places(spark):
    row = spark.sql("select timestamp'2024-01-01 00:00:00' a, timestamp'2024-01-01 00:00:01' b")
    assert row.select(times.hours_between(F.col("a"), F.col("b"))).first()[0] == Decimal("0.000278")


def test_minutes_are_cut(spark):
    row = spark.sql("select timestamp'2024-01-01 00:00:00' a, timestamp'2024-01-01 00:59:59' b")
    assert row.select(times.minutes_between(F.col("a"), F.col("b"))).first()[0] == 59


def test_bad_times_become_null(spark):
    rows = txns(spark, {"timestamp": "not a time"}, {}).drop("event_timestamp")
    assert type_event_time(rows).filter(F.col("event_timestamp").isNull()).count() == 1


def test_source_zone(spark):
    rows = txns(spark, {"timestamp": "2024-01-15T10:00:00"}).drop("event_timestamp")
    assert str(type_event_time(rows).first().event_timestamp) == "2024-01-15 10:00:00"
    assert str(type_event_time(rows, "Asia/Kolkata").first().event_timestamp) == "2024-01-15 04:30:00"


# ---- alerts -------------------------------------------------------------------------------------


def test_alert_filter_severity_and_message(spark):
    rows = txns(
        spark,
        dict(transaction_id="A", is_fraud=True, fraud_score=0.9, fraud_type="DEVICE_ANOMALY"),
        dict(transaction_id="B", is_fraud=True, fraud_score=0.75),
        dict(transaction_id="C", is_fraud=True, fraud_score=0.6),
        dict(transaction_id="D", is_fraud=True, fraud_score=0.59),
        dict(transaction_id="E", is_fraud=False, fraud_score=0.99),
        dict(transaction_id="F", is_fraud=None, fraud_score=0.99),
    )
    alerts = gold.fraud_alerts(rows)
    assert values(alerts, "alert_id", "alert_severity") == [
        ("ALERT_A", "CRITICAL"), ("ALERT_B", "HIGH"), ("ALERT_C", "MEDIUM")]
    messages = dict(values(alerts, "transaction_id", "alert_message"))
    assert messages["A"] == "FRAUD ALERT | DEVICE_ANOMALY | Score:0.9 | Amount:₹100.0 | C1 | Pune"
    # A missing type is skipped, not printed.
    assert messages["B"] == "FRAUD ALERT | Score:0.75 | Amount:₹100.0 | C1 | Pune"
    assert tuple(alerts.columns) == gold.ALERT_COLUMNS


def test_clusters_with_and_without_the_velocity_label(spark):
    alerts = gold.fraud_alerts(txns(
        spark,
        dict(transaction_id="A", is_fraud=True, fraud_score=0.8, fraud_type="VELOCITY_FRAUD"),
        dict(transaction_id="B", is_fraud=True, fraud_score=0.8, fraud_type="IMPOSSIBLE_TRAVEL"),
        dict(transaction_id="C", is_fraud=True, fraud_score=0.95, fraud_type="AML_STRUCTURING", amount=20000.0),
    ))
    labels = [r[0] for r in values(gold.fraud_clusters(alerts), "fraud_cluster")]
    assert labels == ["GENERAL_FRAUD", "GEO_ANOMALY_FRAUD", "HIGH_VALUE_FRAUD"]
    both = RiskParams(velocity_fraud_types=("VELOCITY", "VELOCITY_FRAUD"))
    labels = [r[0] for r in values(gold.fraud_clusters(alerts, both), "fraud_cluster")]
    assert labels == ["GEO_ANOMALY_FRAUD", "HIGH_VALUE_FRAUD", "MICRO_VELOCITY_FRAUD"]


# ---- velocity and structuring -------------------------------------------------------------------


def per_hour(spark, **counts):
    """So many transactions of each customer within one hour."""
    return txns(spark, *[
        dict(transaction_id=f"{c}-{i}", customer_id=c, event_ts=f"2024-01-09 07:{59 * i // n:02d}:30", device_id=f"d{i % 2}", ip_address=f"10.1.0.{i}")
        for c, n in counts.items() for i in range(n)])


def test_a_window_is_listed_above_its_limit(spark):
    assert values(gold.velocity_windows(per_hour(spark, at=15, above=16)), "customer_id", "txn_count") == [("above", 16)]


def test_a_window_ends_with_its_hour(spark):
    rows = per_hour(spark, c=16)
    half = F.when(F.col("transaction_id") == "c-15", F.expr("interval 5 minutes")).otherwise(F.expr("interval 0 minutes"))
    assert gold.velocity_windows(rows.withColumn("event_timestamp", F.col("event_timestamp") + half)).count() == 0


def test_velocity_steps(spark):
    counts = dict(a=10, b=11, c=15, d=16, e=20, f=21, g=30, h=31)
    rows = {r.customer_id: r for r in gold.velocity(per_hour(spark, **counts), AS_OF).collect()}
    assert {c: r.velocity_score for c, r in rows.items()} == dict(a=0.2, b=0.5, c=0.5, d=0.7, e=0.7, f=0.9, g=0.9, h=1.0)
    assert {c: r.txn_count for c, r in rows.items()} == counts
    assert rows["h"].unique_devices == 2 and rows["h"].window_duration_minutes == 57


def test_velocity_skips_failed_and_unknown_status(spark):
    rows = txns(spark, {}, dict(transaction_status="FAILED"), dict(transaction_status=None))
    assert gold.velocity(rows, AS_OF).first().txn_count == 1


def test_structuring_limits(spark):
    amounts = dict(three=(9000.0, 9999.0, 9000.0), two=(9000.0, 9999.0, 9999.01, 8999.99), none=(9999.01,) * 5)
    rows = txns(spark, *[dict(transaction_id=f"{c}{i}", customer_id=c, amount=a) for c, each in amounts.items() for i, a in enumerate(each)])
    assert values(gold.aml_structuring(rows), "customer_id", "structuring_count") == [("three", 3)]


# ---- travel -------------------------------------------------------------------------------------


def drives(spark, hours, **speeds):
    """One drive of each customer along a meridian, at so many kilometres an hour."""
    end = f"2024-01-{9 + hours // 24:02d} {hours % 24:02d}:00:00"
    return txns(spark, *[
        row for c, speed in speeds.items() for row in (
            dict(transaction_id=f"{c}-from", customer_id=c, event_ts="2024-01-09 00:00:00", latitude=10.0),
            dict(transaction_id=f"{c}-to", customer_id=c, event_ts=end, latitude=10.0 + speed * hours / KM_PER_DEGREE))])


def test_travel_steps(spark):
    slow = gold.impossible_travel(drives(spark, 10, still=0.0, below=0.099, a=0.101, b=0.99, c=1.01), AS_OF)
    assert values(slow, "customer_id", "impossible_travel_score") == [("a", 0.5), ("b", 0.5), ("c", 0.85)]
    fast = gold.impossible_travel(drives(spark, 2, a=49.9, b=50.1, c=99.9, d=100.1), AS_OF)
    assert values(fast, "customer_id", "impossible_travel_score") == [("a", 0.85), ("b", 0.95), ("c", 0.95), ("d", 0.99)]
    row = fast.filter("customer_id = 'd'").first()
    assert (row.txn_id_1, row.txn_id_2, row.distance_km, row.implied_speed_kmh) == ("d-from", "d-to", 200.2, 100.0)


def test_same_second_pairs_vanish(spark):
    rows = drives(spark, 2, a=5000.0).withColumn("event_timestamp", F.lit("2024-01-09 00:00:00").cast("timestamp"))
    assert gold.impossible_travel(rows, AS_OF).count() == 0


def test_speed_limit_is_a_parameter(spark):
    strict = RiskParams(as_of=AS_OF.as_of, travel_min_speed_kmh=900)
    rows = drives(spark, 5, below=899.0, above=901.0)
    assert values(gold.impossible_travel(rows, strict), "customer_id") == [("above",)]


def test_tied_times_are_ordered_by_id(spark):
    rows = txns(spark, *[dict(transaction_id=t) for t in ("C", "A", "B")])
    pairs = values(gold.with_previous(rows.repartition(3)), "transaction_id", "prev_transaction_id")
    assert pairs == [("A", None), ("B", "A"), ("C", "B")]


# ---- look-back ----------------------------------------------------------------------------------


def test_lookback_follows_as_of_and_the_clock(spark):
    rows = txns(spark, {}, dict(event_ts="2023-12-01 00:00:00"))
    assert gold.recent(rows, AS_OF).count() == 1
    assert gold.recent(rows).count() == 0
    now = rows.withColumn("event_timestamp", F.current_timestamp())
    assert gold.recent(now).count() == 2


# ---- merchants and customers --------------------------------------------------------------------

MERCHANT = """merchant_id string, merchant_name string, merchant_category string, risk_category string, city string,
    state string, historical_fraud_score double, merchant_tenure_days int"""


def test_merchant_score_and_tier(spark):
    rows = txns(spark, *[dict(transaction_id=str(i), is_fraud=i < 1) for i in range(10)],
                *[dict(transaction_id=f"x{i}", merchant_id="UNKNOWN") for i in range(3)])
    dim = spark.createDataFrame([("M1", "Shop", "FUEL", "LOW", "Pune", "MH", 0.5, 30)], MERCHANT)
    scores = {r.merchant_id: r for r in gold.merchant_scores(rows, dim, AS_OF).collect()}
    assert float(scores["M1"].fraud_rate_pct) == 10.0
    assert scores["M1"].computed_risk_score == pytest.approx(0.5 * 0.4 + 0.1 * 0.4 + 0.2)
    assert scores["M1"].merchant_risk_tier == "HIGH"
    # LEAST ignores the null score of a merchant without a dimension row.
    assert scores["UNKNOWN"].computed_risk_score == 1.0 and scores["UNKNOWN"].merchant_risk_tier == "LOW"
    fixed = RiskParams(as_of=AS_OF.as_of, missing_merchant_history=0.0)
    scores = {r.merchant_id: r for r in gold.merchant_scores(rows, dim, fixed).collect()}
    assert scores["UNKNOWN"].computed_risk_score == 0.0


def test_profiles_join_the_current_version_only(spark):
    rows = txns(spark, *[dict(transaction_id=str(i), amount=9500.0 if i == 0 else 100.0) for i in range(4)])
    changes = spark.createDataFrame(
        [("C1", "PENDING", 1), ("C1", "VERIFIED", 2)], "customer_id string, kyc_status string, seq int"
    ).withColumns({
        "full_name": F.lit("A"), "account_status": F.lit("ACTIVE"), "risk_score": F.lit(0.1),
        "account_age_days": F.lit(3), "income_band": F.lit("LOW"), "is_politically_exposed": F.lit(False),
        "country": F.lit("IN"), "city": F.lit("Pune"), "state": F.lit("MH"),
    })
    history = silver.customers_history(changes, ["seq"])
    assert history.count() == 2
    assert gold.customer_profiles(rows, history, AS_OF).count() == 2
    profile = gold.customer_profiles(rows, cdc.current_versions(history), AS_OF).collect()
    assert len(profile) == 1 and profile[0].kyc_status == "VERIFIED"
    # One device and one city of ten, one structured amount of four.
    assert float(profile[0].computed_risk_score) == pytest.approx(0.01 + 0.01 + 0.25 * 0.2)
    assert profile[0].customer_risk_tier == "LOW"
    assert profile[0].txn_amount_stddev == pytest.approx(4700.0)


def test_single_transaction_has_no_deviation(spark):
    assert gold.customer_stats(txns(spark, {}), AS_OF).first().txn_amount_stddev is None


# ---- monitoring ---------------------------------------------------------------------------------


def days(spark, counts):
    return spark.createDataFrame([(i, n) for i, n in enumerate(counts)], "d int, n int").select(
        F.expr("date_add(date'2024-01-01', d)").alias("transaction_date"),
        F.explode(F.sequence(F.lit(1), F.col("n"))).alias("k"),
    ).select("transaction_date", F.lit(1.0).alias("amount"), F.col("k").cast("string").alias("customer_id"))


def test_spike_needs_the_trailing_frame(spark):
    rows = days(spark, [10, 11, 10, 9, 10, 11, 10, 500])
    assert monitoring.daily_anomalies(rows).filter("is_anomaly").count() == 0
    found = monitoring.daily_anomalies(rows, RiskParams(trailing_frame=True)).filter("is_anomaly").collect()
    assert [str(r.transaction_date) for r in found] == ["2024-01-08"]
    assert found[0].anomaly_severity == "CRITICAL"


def test_days_without_spread(spark):
    result = monitoring.daily_anomalies(days(spark, [5] * 9)).collect()
    assert {r.txn_count_z_score for r in result} == {0.0}


def test_health_levels_and_empty_layer(spark):
    def layer(ts):
        return spark.createDataFrame([(ts,)], "t string").select(F.col("t").cast("timestamp").alias("t"))

    health = monitoring.pipeline_health(
        layer("2024-01-30 23:50:00"), layer("2024-01-30 23:20:00"), layer("2024-01-30 22:00:00").limit(0),
        AS_OF, "t", "t", "t")
    assert values(health, "layer_table", "lag_minutes", "health_status") == [
        ("bronze_transactions", 10, "HEALTHY"), ("silver_transactions", 40, "WARNING")]


# ---- silver -------------------------------------------------------------------------------------


def fx(spark, rows):
    return spark.createDataFrame(rows, "currency_code string, rate_date string, usd_multiplier double, at int").select(
        "currency_code", F.col("rate_date").cast("date").alias("rate_date"), "usd_multiplier", "at")


@pytest.mark.parametrize("max_rows", [100, 1])
def test_fx_fallback_and_duplicate_rates(spark, max_rows):
    """The same rows by broadcast and, beyond the size limit, by salted join."""
    rows = txns(spark, dict(transaction_id="A", currency="USD"), dict(transaction_id="B", currency="EUR"),
                dict(transaction_id="C", currency=None))
    rates = silver.exchange_rates(
        fx(spark, [("USD", "2024-01-15", 2.0, 1), ("USD", "2024-01-15", 3.0, 2), ("USD", "2024-01-16", 9.0, 1)]), "at")
    priced = silver.with_usd_amount(rows, rates, max_broadcast_rows=max_rows)
    assert values(priced, "transaction_id", "amount_usd") == [("A", 300.0), ("B", 100.0), ("C", 100.0)]
    assert set(priced.columns) == {*rows.columns, "amount_usd"}


def test_union_counts_twice_unless_deduplicated(spark):
    live = txns(spark, {}).drop("timestamp")
    landed = txns(spark, {}, dict(transaction_id="T2"))
    both = silver.transactions_unified(live, landed)
    assert both.count() == 3 and both.filter(F.col("timestamp").isNull()).count() == 1
    assert silver.transactions_unified(live, landed, ["transaction_id"]).count() == 2


def test_landed_path_has_two_bands_and_drops(spark):
    rows = txns(spark, dict(transaction_id="A", fraud_score=0.7), dict(transaction_id="B", fraud_score=0.8),
                dict(transaction_id="B", fraud_score=0.8), dict(transaction_id="C", currency="XXX"),
                dict(transaction_id="D", currency="usd"))
    cleaned = silver.transactions_landed_cleaned(rows, AS_OF.as_of)
    assert values(cleaned, "transaction_id", "risk_band") == [("A", "LOW"), ("B", "CRITICAL"), ("D", "LOW")]


def test_cleaned_table_leaves_transport_columns_behind(spark):
    envelopes = inputs.envelopes(spark, SF)
    table = silver.transactions_cleaned(bronze.transactions_raw(envelopes))
    assert not set(silver.TRANSPORT_COLUMNS) & set(table.columns)
    assert {"transaction_id", "event_timestamp", "transaction_date", "_layer"} <= set(table.columns)


def test_distinct_values_are_counted_beside_the_sums(spark):
    """No row is multiplied with all its sums; nulls are no value, and unknown customers are one."""
    rows = txns(
        spark, dict(device_id="a", ip_address=None), dict(device_id="b", ip_address=None), dict(device_id="a", ip_address=None),
        dict(customer_id=None, device_id="a"), dict(customer_id=None, device_id=None))
    stats = gold.customer_stats(rows, AS_OF)
    assert "Expand" not in stats._jdf.queryExecution().optimizedPlan().toString()
    got = {r.customer_id is None: (r.total_txns_30d, r.unique_devices_30d, r.unique_ips_30d) for r in stats.collect()}
    assert got[False] == (3, 2, 0) and got[True][:2] == (2, 1)
