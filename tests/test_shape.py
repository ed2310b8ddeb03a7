"""What the physical plans may and may not contain."""

import re

import pytest

import __spark_entry__ as entry
from conftest import SF

STREAMED = ("src_", "sink_", "stream_", "dedup_watermark")
BATCH = [k for k in entry.queries() if not k.startswith(STREAMED)]


def plan(spark, key):
    df = entry.queries()[key](spark, SF)
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("key", BATCH)
def test_no_cross_join_and_no_python_in_the_plan(spark, key):
    text = plan(spark, key)
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text
    assert "Python" not in text and "ArrowEval" not in text


@pytest.mark.parametrize("key, filters", [
    ("impossible_travel", "GreaterThanOrEqual(ts,2024-01-01T00:00)"),
    ("velocity_hourly", "GreaterThanOrEqual(ts,2024-01-01T00:00)"),
    ("merchant_scores", "GreaterThanOrEqual(ts,2024-01-01T00:00)"),
    ("customer_stats_30d", "GreaterThanOrEqual(ts,2024-01-01T00:00)"),
])
def test_lookback_reaches_the_scan(spark, key, filters):
    assert filters in plan(spark, key)


@pytest.mark.parametrize("key, columns", [
    ("aml_structuring", {"event_id", "user_id", "value"}),
    ("impossible_travel", {"event_id", "ts", "user_id", "value"}),
    ("daily_totals", {"event_id", "ts", "user_id", "value"}),
])
def test_scan_reads_only_what_is_needed(spark, key, columns):
    schema = re.search(r"ReadSchema: struct<([^>]*)>", plan(spark, key)).group(1)
    assert {c.split(":")[0] for c in schema.split(",")} == columns


@pytest.mark.parametrize("key, shuffles", [
    ("impossible_travel", 1), ("lag_previous_txn", 1), ("aml_structuring", 1), ("ops_kpis", 1),
    ("scd1_transactions", 1), ("dedup_exact", 1), ("scd2_customers", 1), ("silver_rules", 0), ("bronze_enrich", 0),
])
def test_number_of_shuffles(spark, key, shuffles):
    assert plan(spark, key).count("Exchange hashpartitioning") == shuffles
