"""Nothing gets lost or depends on the run on the way in."""

import json
from datetime import datetime
from pathlib import Path

from pyspark.sql import functions as F

from veriflux.operators.audit import type_event_time
from veriflux.operators.cdc import scd1
from veriflux.plans import silver
from veriflux.sources.files import infer_schema


def test_a_field_of_one_row_is_in_the_schema(spark, folder):
    rows = [json.dumps({"a": k}) for k in range(2000)] + [json.dumps({"a": 1, "late": "x"})]
    Path(folder, "rows.json").write_text("\n".join(rows))
    assert infer_schema(spark, folder, "json").fieldNames() == ["a", "late"]


def test_columns_of_all_parquet_files_are_in_the_schema(spark, folder):
    spark.range(1).withColumn("x", F.lit(1)).write.parquet(f"{folder}/t")
    spark.range(1).withColumn("y", F.lit(1)).write.mode("append").parquet(f"{folder}/t")
    assert set(infer_schema(spark, f"{folder}/t", "parquet").fieldNames()) == {"id", "x", "y"}


def test_zone_applies_to_times_without_offset_only(spark):
    texts = ["2024-01-31 10:00:00", "2024-01-31T10:00:00Z", "2024-01-31 10:00:00+02:00", "2024-01-31"]
    df = spark.createDataFrame([(t, "2024-01-31") for t in texts], "timestamp string, transaction_date string")
    got = [r.event_timestamp for r in type_event_time(df, "Asia/Kolkata").select(F.col("event_timestamp").cast("timestamp_ntz")).collect()]
    assert got == [datetime(2024, 1, 31, 4, 30), datetime(2024, 1, 31, 10), datetime(2024, 1, 31, 8), datetime(2024, 1, 30, 18, 30)]


def test_rates_that_tie_or_are_null(spark):
    rows = [("EUR", "d", 1.0, 1), ("EUR", "d", 2.0, 1), ("EUR", "d", None, 2)]
    schema = "currency_code string, rate_date string, usd_multiplier double, _ingested_at int"
    for order in (rows, rows[::-1]):
        assert [r.usd_multiplier for r in silver.exchange_rates(spark.createDataFrame(order, schema)).collect()] == [2.0]


def test_run_stamps_do_not_decide_ties(spark):
    rows = [("k", "A", 1), ("k", "B", 1)]
    found = set()
    for stamps in ((1, 2), (2, 1), (7, 7)):
        df = spark.createDataFrame([(*r, s) for r, s in zip(rows, stamps, strict=True)], "id string, v string, seq int, _processed_at int")
        found |= {r.v for r in scd1(df, ["id"], ["seq"]).collect()}
    assert len(found) == 1
