"""Messages and files to gold tables, end to end."""

from pyspark.sql import functions as F

from conftest import SF
from veriflux.operators import quality
from veriflux.params import RiskParams
from veriflux.plans import bronze, gold
from veriflux.plans.refresh import refresh_gold, refresh_silver
from veriflux.session import sized_for
from veriflux.sources import bus
from workload import inputs

PARAMS = RiskParams(as_of=inputs.AS_OF)


def test_from_messages_to_gold(spark):
    raw = bronze.transactions_raw(inputs.envelopes(spark, SF))
    live, rejected = quality.split(raw, bus.is_malformed())
    assert {r[0] for r in rejected.select("_quarantine_reason").distinct().collect()} == {"MALFORMED_JSON"}
    landed = bronze.transactions_landed(
        inputs.landing(spark, SF).withColumn("transaction_id", F.concat(F.lit("S3_"), "transaction_id")))
    silver = refresh_silver(
        live.drop("_corrupt_record"), landed, inputs.merchant_changes(spark, SF).withColumn("_ingested_at", F.col("seq")),
        inputs.customer_changes(spark, SF).withColumn("_ingested_at", F.col("change_id")),
        inputs.fx_records(spark, SF), PARAMS)
    assert silver["transactions_cleaned"].count() == live.count()
    tables = refresh_gold(silver, PARAMS, bronze=live)
    health = {r.layer_table: r.row_count for r in tables["pipeline_health"].collect()}
    assert health == {"bronze_transactions": live.count(), "silver_transactions": live.count(), "gold_fraud_alerts": tables["fraud_alerts"].count()}
    assert spark.sql("SELECT count(*) FROM transactions_unified").first()[0] == silver["transactions_unified"].count()
    assert all(t.limit(1).count() for t in tables.values())

    unified = silver["transactions_unified"]
    plan = gold.impossible_travel(unified, RiskParams(as_of=inputs.LATER, partition_column="transaction_date"))
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert text.count("PartitionFilters: [isnotnull(transaction_date") == 2
    assert text.count("GreaterThanOrEqual(event_timestamp") == 2

    direct = gold.impossible_travel(unified, PARAMS).drop("detected_at")
    assert tables["impossible_travel"].drop("detected_at").exceptAll(direct).count() == 0
    failed = {r.rule: r.failed for r in silver["quality"].collect()}
    assert failed["valid_currency"] == 0 and set(failed) == set(quality.silver_rules())
    profiles = tables["customer_profiles"]
    assert profiles.count() == profiles.select("customer_id").distinct().count()
    assert quality.report(profiles, quality.gold_rules()).filter("failed > 0").count() == 0


def test_cluster_settings_follow_the_data():
    assert sized_for(100 << 40, 4000)["spark.sql.shuffle.partitions"] == str((100 << 40) // (256 << 20))
    assert sized_for(1 << 20, 8)["spark.sql.shuffle.partitions"] == "16"
