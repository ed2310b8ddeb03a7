import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from conftest import SF
from test_rules import txns
from veriflux.functions.hashing import null_safe_hash, plain_hash
from veriflux.operators import quality
from veriflux.operators.audit import add_audit_columns
from veriflux.plans import bronze
from veriflux.schemas import TRANSACTION
from veriflux.sources import bus
from workload import inputs


def test_track_keeps_rows_and_counts(spark):
    rows = txns(spark, {}, dict(amount=-100.0), dict(amount=None), dict(customer_id=None))
    tracked, observation = quality.track(rows, quality.BRONZE_RULES)
    assert tracked.count() == 4
    assert observation.get == {
        "transaction_id_present": 0, "amount_positive": 2, "timestamp_present": 0, "customer_id_present": 1}


def test_drop_treats_unknown_as_failed(spark):
    rows = txns(spark, {}, dict(amount=-100.0), dict(amount=None))
    assert quality.drop_violations(rows, {"positive": "amount > 0"}).count() == 1


def test_fail_raises_with_the_rule_name(spark):
    bad = txns(spark, {}, dict(fraud_score=-0.1))
    with pytest.raises(PySparkException, match="no_negative_fraud_score"):
        # Also when no column of the rule is selected.
        quality.fail_on_violation(bad, quality.ALERT_FAIL_RULES).select("transaction_id").collect()
    good = txns(spark, {})
    assert quality.fail_on_violation(good, quality.ALERT_FAIL_RULES).count() == 1


@pytest.mark.parametrize("change, rule", [
    (dict(amount=0.0), "valid_amount_range"), (dict(amount=10_000_001.0), "valid_amount_range"),
    (dict(currency="XXX"), "valid_currency"), (dict(currency=None), "valid_currency"),
    (dict(payment_method="CASH"), "valid_payment_method"), (dict(transaction_status="UNKNOWN"), "valid_status"),
    (dict(device_type=None), "valid_device_type"), (dict(fraud_score=1.01), "valid_fraud_score"),
    (dict(event_ts="2024-01-31 06:00:01"), "no_future_timestamp"), (dict(event_ts=None), "no_future_timestamp"),
])
def test_silver_rules(spark, change, rule):
    row = quality.annotate(txns(spark, change), quality.silver_rules("2024-01-31 00:00:00")).first()
    assert row._violations == [rule]


def test_silver_rules_allow_mixed_case_and_the_buffer(spark):
    rows = txns(spark, dict(currency="inr", payment_method="upi", event_ts="2024-01-31 06:00:00"))
    assert quality.annotate(rows, quality.silver_rules("2024-01-31 00:00:00")).first()._violations == []


def test_amount_limit_is_a_parameter(spark):
    rows = txns(spark, dict(amount=2_000_000.0))
    assert quality.drop_violations(rows, quality.silver_rules()).count() == 1
    assert quality.drop_violations(rows, quality.silver_rules(max_amount=1_000_000)).count() == 0


def test_report_matches_annotations(spark):
    rows = inputs.messy(spark, SF)
    rules = {**quality.BRONZE_RULES, **quality.silver_rules(inputs.AS_OF)}
    report = {r.rule: r.failed for r in quality.report(rows, rules).collect()}
    counted = quality.annotate(rows, rules).select(F.explode("_violations").alias("v")).groupBy("v").count()
    assert {r.v: r["count"] for r in counted.collect()} == {k: v for k, v in report.items() if v}


def test_null_rates(spark):
    rows = txns(spark, *[dict(device_type=None if i == 0 else "POS") for i in range(10)])
    gate = {r.column_name: (r.null_pct, r.quarantine)
            for r in quality.null_rates(rows, ["device_type", "amount"], 5.0).collect()}
    assert gate == {"device_type": (10.0, True), "amount": (0.0, False)}


def test_split_is_complete_and_ordered(spark):
    rows = inputs.messy(spark, SF)
    valid, rejected = quality.split(rows)
    assert valid.count() + rejected.count() == rows.count()
    assert valid.filter("transaction_id is null or amount is null or amount <= 0").count() == 0
    first = txns(spark, dict(transaction_id=None, amount=None), dict(amount=None), dict(amount=0.0))
    reasons = [r._quarantine_reason for r in quality.split(first)[1].collect()]
    assert reasons == ["NULL_TRANSACTION_ID", "NULL_AMOUNT", "INVALID_AMOUNT"]


def envelope(spark, *bodies):
    rows = [(b"k", body.encode(), "payments", 0, i) for i, body in enumerate(bodies)]
    schema = "key binary, value binary, topic string, partition int, offset bigint"
    return spark.createDataFrame(rows, schema).withColumn("timestamp", F.current_timestamp())


def test_messages_and_malformed_bodies(spark):
    rows = bus.unpack(envelope(
        spark, '{"transaction_id":"TXN_001","amount":1000.0}', "MALFORMED_JSON{{{",
        '{"transaction_id":"TXN_002","amount":2000.0}'))
    assert rows.filter(F.col("transaction_id").isNotNull()).count() == 2
    _, rejected = quality.split(rows, bus.is_malformed())
    assert [(r._quarantine_reason, r._corrupt_record) for r in rejected.collect()] == [
        ("MALFORMED_JSON", "MALFORMED_JSON{{{")]
    # Without the malformed test they share the reason of a missing id.
    assert bronze.dead_letter(rows).first()._quarantine_reason == "NULL_TRANSACTION_ID"


def test_pack_and_unpack(spark):
    rows = inputs.landing(spark, SF)
    packed = bus.pack(rows).withColumns({
        "topic": F.lit("t"), "partition": F.lit(0), "offset": F.lit(0), "timestamp": F.current_timestamp()})
    names = [part.split()[0] for part in TRANSACTION.split(",") if part.split()[0] in rows.columns]
    back = bus.unpack(packed).withColumn("transaction_date", F.col("transaction_date").cast("date")).select(*names)
    assert back.exceptAll(rows.select(*names)).count() == 0 and back.count() == rows.count()


def test_hashes(spark):
    df = spark.createDataFrame([(None, "a"), ("a", None)], "x string, y string")
    assert df.select(plain_hash("x", "y")).distinct().count() == 1
    assert df.select(null_safe_hash("x", "y")).distinct().count() == 2
    kyc = spark.createDataFrame([("PENDING", 0.3), ("VERIFIED", 0.1), ("VERIFIED", 0.1)], "k string, r double")
    old, new, same = [r[0] for r in kyc.select(plain_hash("k", "r")).collect()]
    assert old != new and new == same


def test_record_hash_does_not_depend_on_the_run(spark):
    rows = txns(spark, {})
    once = add_audit_columns(rows, "BRONZE", "p")
    twice = add_audit_columns(once, "SILVER", "p")
    assert once.first()._record_hash == twice.first()._record_hash
    assert (twice.first()._layer, twice.first()._pipeline_name) == ("SILVER", "p")


def test_gold_rules_name_the_existing_score(spark):
    rows = spark.createDataFrame([(0.5, "LOW", 0.2), (-1.0, "NONE", 1.2)],
                                 "max_fraud_score double, customer_risk_tier string, computed_risk_score double")
    found = [r._violations for r in quality.annotate(rows, quality.gold_rules()).collect()]
    assert found == [[], ["no_negative_fraud_score", "valid_risk_tier", "composite_score_bounded"]]
