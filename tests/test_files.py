import glob

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from conftest import SF
from veriflux import schemas
from veriflux.params import RiskParams
from veriflux.plans import bronze, gold
from veriflux.sinks.bus import publish
from veriflux.sinks.files import create_layers, save_table, write_csv, write_partitioned
from veriflux.sources import bus
from veriflux.sources.files import infer_schema, read_files, stream_files
from workload import inputs


def test_inferred_parquet_schema(spark, folder):
    rows = inputs.landing(spark, SF)
    rows.write.parquet(f"{folder}/in")
    assert infer_schema(spark, f"{folder}/in", "parquet").simpleString() == rows.schema.simpleString()
    assert "_source_file" in stream_files(spark, f"{folder}/in", "parquet").columns


def test_inferred_csv_types(spark, folder):
    write_csv(inputs.merchant_files(spark, SF), f"{folder}/in", single_file=True)
    assert len(glob.glob(f"{folder}/in/*.csv")) == 1
    rows = read_files(spark, f"{folder}/in", "csv")
    assert rows.schema["historical_fraud_score"].dataType.simpleString() == "double"
    assert rows.filter(F.col("_source_file").contains(".csv")).count() == rows.count()


def test_joined_lists_split_again(spark, folder):
    write_csv(inputs.customer_files(spark, SF), f"{folder}/in")
    rows = read_files(spark, f"{folder}/in", "csv", schemas.CUSTOMER)
    assert rows.filter(F.size(F.split("registered_devices", r"\|")) != 2).count() == 0


def test_rerun_replaces_only_its_partitions(spark, folder):
    rows = inputs.landing(spark, SF)
    write_partitioned(rows, f"{folder}/out", ["transaction_date"])
    one_day = rows.filter(F.col("transaction_date") == F.lit("2024-01-05").cast("date"))
    write_partitioned(one_day.withColumn("amount", F.lit(0.0)), f"{folder}/out", ["transaction_date"])
    back = spark.read.parquet(f"{folder}/out")
    assert back.count() == rows.count()
    assert back.filter("transaction_date = '2024-01-05' and amount <> 0").count() == 0
    assert back.filter("amount <> 0").count() > 0


def test_lookback_prunes_partitions(spark, folder):
    rows = inputs.transactions(spark, SF)
    write_partitioned(rows, f"{folder}/out", ["transaction_date"])
    params = RiskParams(as_of=inputs.LATER, partition_column="transaction_date")
    recent = gold.recent(spark.read.parquet(f"{folder}/out"), params)
    plan = recent._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(transaction_date" in plan and "PushedFilters: [IsNotNull(event_timestamp" in plan
    assert recent.count() == gold.recent(rows, params).count() < rows.count()


def test_envelope_replay_is_a_stream(spark, folder):
    inputs.envelopes(spark, SF).write.parquet(f"{folder}/in")
    raw = bronze.transactions_raw(bus.replay(spark, f"{folder}/in", files_per_trigger=2))
    assert raw.isStreaming and {"_kafka_offset", "event_timestamp", "_record_hash"} <= set(raw.columns)


def test_live_topic_needs_the_connector(spark):
    with pytest.raises(AnalysisException, match="(?i)kafka"):
        bus.subscribe(spark, "broker:9092", "payments")
    with pytest.raises(AnalysisException, match="(?i)kafka"):
        publish(inputs.landing(spark, SF), "broker:9092", "payments")


def test_layers_and_tables(spark):
    names = {r[0] for r in create_layers(spark).collect()}
    assert {"bronze", "silver", "gold"} <= names
    for _ in range(2):
        save_table(inputs.merchants(spark, SF), "silver.merchants_current")
    assert spark.table("silver.merchants_current").count() == 10
