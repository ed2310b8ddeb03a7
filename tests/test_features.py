"""Gated publishing, stored rule counts, unknown fields, day partials, footers, epochs and late rows."""

import json
import uuid

import pytest
from pyspark.sql import functions as F

from conftest import SF
from veriflux.operators import audit, quality
from veriflux.params import RiskParams
from veriflux.plans import gold, monitoring, partials, silver
from veriflux.sinks.publish import GatedTable
from veriflux.sources import drift
from veriflux.sources.files import stream_files
from veriflux.streaming.late import mark_late
from veriflux.streaming.rule_counts import RuleCounts
from veriflux.streaming.run import drain, keyed_state, to_files
from veriflux.streaming.windows import windowed_activity
from workload import inputs


def days(spark, **amounts):
    rows = [(f"{d}-{i}", f"2024-01-{d[1:]}", a) for d, values in amounts.items() for i, a in enumerate(values)]
    return spark.createDataFrame(rows, "id string, d string, amount double").select("id", "amount", F.col("d").cast("date").alias("day"))


def test_only_days_that_hold_are_published(spark, folder):
    table = GatedTable(spark, f"t_{uuid.uuid4().hex}", folder, "day")
    rules = {"positive": "amount > 0"}
    report = table.publish(days(spark, d01=[1.0, 2.0], d02=[1.0, -1.0, None]), "a", rules, 40.0)
    assert {(r.day.day, r.failed, r.total, r.holds) for r in report.collect()} == {(1, 0, 2, True), (2, 2, 3, False)}
    assert {r.id for r in table.table().collect()} == {"d01-0", "d01-1"}
    assert table.staged("a").filter("day = date'2024-01-02'").count() == 3
    table.publish(days(spark, d02=[5.0]), "b", rules, 40.0)  # a better delivery
    table.publish(days(spark, d01=[-7.0, 8.0, 9.0]), "c", rules, 10.0)  # a worse one: the old day stays
    assert {(r.id, r.amount) for r in table.table().collect()} == {("d01-0", 1.0), ("d01-1", 2.0), ("d02-0", 5.0)}
    table.publish(days(spark, d01=[-7.0, 8.0, 9.0]), "c", rules, 50.0)
    assert table.table().filter("day = date'2024-01-01'").count() == 3


def test_rule_counts_are_stored_per_batch(spark, folder):
    for low in (0, 10):
        spark.range(low, low + 10).coalesce(1).write.mode("append").parquet(f"{folder}/in")
    feed = stream_files(spark, f"{folder}/in", "parquet", spark.range(1).schema, 1)
    with RuleCounts(spark, f"{folder}/counts") as counts:
        counts.wait(to_files(quality.track_stream(feed, {"even": "id % 2 = 0", "low": "id < 10"}, "x"), f"{folder}/o", f"{folder}/c"))
        counts.wait(to_files(quality.track_stream(feed, {"low": "id < 10"}, "y"), f"{folder}/p", f"{folder}/d"))
    assert sorted((r.name, r.rule, r.batch, r.failed, r.total) for r in counts.batches().collect()) == [
        ("x", "even", 0, 5, 10), ("x", "even", 1, 5, 10), ("x", "low", 0, 0, 10), ("x", "low", 1, 10, 10), ("y", "low", 0, 0, 10), ("y", "low", 1, 10, 10)]
    assert {(r.name, r.rule, r.passed, r.failed, r.total) for r in counts.report().collect()} == {("x", "even", 10, 10, 20), ("x", "low", 10, 10, 20), ("y", "low", 10, 10, 20)}


def test_unknown_fields_are_kept(spark, folder):
    lines = [{"a": 1, "b": "x"}, {"a": 2, "new": {"deep": [1, 2]}}, {"new": 5}, {"a": "text", "c": None}]
    text = [json.dumps(x) for x in lines] + ["{broken", "[1]", ""]
    rows = drift.unpack_json(spark.createDataFrame([(t,) for t in [*text, None]], "value string"), "a INT, b STRING").persist()
    got = rows.select("a", "b", F.to_json("_unknown_fields").alias("u"), "_corrupt_record").collect()
    assert [(r.a, r.b, r.u, r["_corrupt_record"]) for r in got] == [
        (1, "x", None, None), (2, None, '{"new":{"deep":[1,2]}}', None), (None, None, '{"new":5}', None), (None, None, '{"c":null}', None),
        (None, None, None, "{broken"), (None, None, None, "[1]"), (None, None, None, ""), (None, None, None, None)]
    assert "new" in drift.unknown_schema(rows)
    assert [r.n for r in rows.select(drift.unknown("new", "int").alias("n")).collect()] == [None, None, 5, None, None, None, None, None]


@pytest.mark.parametrize("as_of", ["2024-01-31 00:00:00", "2024-01-30 13:45:10"])
def test_partials_equal_a_full_count(spark, folder, as_of):
    params = RiskParams(as_of=as_of)
    rows = inputs.messy(spark, SF).withColumn("event_timestamp", F.col("event_timestamp").cast("timestamp"))
    rows = rows.filter("event_timestamp < timestamp'2024-03-01'")  # messy times differ from their dates
    partials.refresh_days(rows, folder, params)
    merged = partials.customer_stats(spark.read.parquet(folder), rows, params)
    full = gold.customer_stats(rows, params)

    def plain(df):
        out = {}
        for r in df.collect():
            out[r.customer_id] = {k: round(v, 6) if isinstance(v, float) else v for k, v in r.asDict().items()}
        return out

    assert plain(merged.select(full.columns)) == plain(full)


def test_health_reads_footers_only(spark, folder):
    rows = inputs.transactions(spark, SF)
    monitoring.with_micros(rows, "event_timestamp").write.parquet(f"{folder}/a")
    monitoring.with_micros(rows.limit(0), "event_timestamp").write.parquet(f"{folder}/b")
    with monitoring.from_footers(spark):
        plan = monitoring.footer_counts(spark, f"{folder}/a")._jdf.queryExecution().executedPlan().toString()
    assert "PushedAggregation: [COUNT(*), MIN(_event_us), MAX(_event_us)]" in plan
    params = RiskParams(as_of="2024-01-31 00:00:00")
    got = monitoring.stored_health(spark, {"a": f"{folder}/a", "b": f"{folder}/b"}, params).drop("computed_at").collect()
    want = monitoring.layer_health("a", rows.withColumn("event_timestamp", F.col("event_timestamp").cast("timestamp")), "event_timestamp", params).first()
    assert [tuple(r)[:5] for r in got] == [tuple(want)]


def test_epochs_order_across_partitions(spark):
    rows = spark.createDataFrame([("t", 0, 900, "old"), ("t", 1, 5, "new"), ("u", 1, 7, "a"), ("u", 0, 950, "b"), ("v", 9, 1, "c")],
                                 "transaction_id string, _kafka_partition int, _kafka_offset long, device_id string")
    before = rows.filter("device_id = 'old'")
    marks = silver.next_epoch(silver.first_epoch(before), before, fresh=[1])
    assert {tuple(r) for r in marks.collect()} == {(0, 0, 0), (0, 901, 1), (1, 0, 1)}
    got = silver.transactions_cleaned(silver.topic_epochs(rows, marks), ["_epoch", "_kafka_offset"]).collect()
    assert {(r.transaction_id, r.device_id) for r in got} == {("t", "new"), ("u", "b"), ("v", "c")}


def test_named_zones_are_not_shifted(spark):
    rows = spark.createDataFrame([(t, "2024-01-01") for t in (
        "2024-01-01 10:00:00 Europe/Paris", "2024-01-01T10:00:00Z", "2024-01-01 10:00:00+01:00", "2024-01-01 10:00:00", "2024-01-01 10:00:00 UTC", "x", None)],
        "timestamp string, transaction_date string")
    times = [r.t for r in audit.type_event_time(rows, "Asia/Kolkata").select(F.date_format("event_timestamp", "HH:mm").alias("t")).collect()]
    assert times == ["09:00", "10:00", "09:00", "04:30", "10:00", None, None]


def test_kept_and_late_rows_are_all_rows(spark, folder):
    """What is marked late is what Spark's window operator counts as dropped."""
    for n, times in enumerate((["10:05"], ["15:00"], ["16:00", "15:31"], ["10:10", "15:29", "15:30"], ["23:00"])):
        rows = [(f"{n}{i}", f"c{n}{i}", "M", 1.0, f"2024-01-01 {t}:00") for i, t in enumerate(times)] + [(f"{n}x", "c", "M", 1.0, None)] * (n == 1)
        df = spark.createDataFrame(rows, "transaction_id string, customer_id string, merchant_id string, amount double, t string")
        df.withColumn("event_timestamp", F.col("t").cast("timestamp")).drop("t").coalesce(1).write.mode("append").parquet(f"{folder}/in")
    schema = spark.read.parquet(f"{folder}/in").schema

    def feed():
        return stream_files(spark, f"{folder}/in", "parquet", schema, 1).drop("_source_file")

    drain(to_files(mark_late(feed(), "event_timestamp", "customer_id", "30 minutes"), f"{folder}/marked", f"{folder}/1"))
    marked = spark.read.parquet(f"{folder}/marked").collect()
    assert len(marked) == 9 and {r.transaction_id for r in marked if r._late} == {"30", "31"}
    with keyed_state(spark):
        windows = to_files(windowed_activity(feed().withWatermark("event_timestamp", "30 minutes")), f"{folder}/windows", f"{folder}/2")
    drain(windows)
    # A window of an hour is dropped when it has ended: 15:29 is late, but its window is open still.
    assert sum(s.numRowsDroppedByWatermark for p in windows.recentProgress for s in p.stateOperators) == 1


def test_quarantine_of_streams_and_batches(spark, folder):
    rows = inputs.messy(spark, SF).withColumn("event_timestamp", F.col("event_timestamp").cast("timestamp"))
    rows.write.parquet(f"{folder}/in")
    feed = stream_files(spark, f"{folder}/in", "parquet", rows.schema).withWatermark("event_timestamp", "30 minutes")
    drain(to_files(silver.transactions_landed_cleaned(feed, inputs.AS_OF, quarantine=True).select("offset"), f"{folder}/kept", f"{folder}/1"))
    drain(to_files(silver.unkeyed(feed).select("offset"), f"{folder}/aside", f"{folder}/2"))
    batch = silver.transactions_landed_cleaned(rows, inputs.AS_OF, quarantine=True)
    kept = {r.offset for r in spark.read.parquet(f"{folder}/kept").collect()}
    assert kept == {r.offset for r in batch.collect()}
    aside = {r.offset for r in spark.read.parquet(f"{folder}/aside").collect()}
    assert aside == {r.offset for r in rows.filter("transaction_id is null").collect()} and not aside & kept
