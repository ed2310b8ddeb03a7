import time
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from conftest import SF
from test_rules import txns
from veriflux.operators import quality
from veriflux.operators.cdc import drop_duplicates, scd1, scd2
from veriflux.operators.ordered import SkewPolicy
from veriflux.params import RiskParams
from veriflux.plans import bronze, gold, silver
from veriflux.session import shared_dir
from veriflux.sources.files import stream_files
from veriflux.streaming.alerts import alerts_once
from veriflux.streaming.run import drain, to_batches, to_files
from veriflux.streaming.travel import TravelStream
from veriflux.streaming.upsert import Scd1Stream, Scd2Stream
from veriflux.streaming.windows import windowed_activity
from workload import inputs, streams


class Feed:
    """A folder to which rows are delivered, one file per delivery."""

    def __init__(self, spark, folder, schema):
        self.spark, self.path, self.schema = spark, f"{folder}/in", schema

    def deliver(self, rows):
        rows.coalesce(1).write.mode("append").parquet(self.path)

    def stream(self):
        return stream_files(self.spark, self.path, "parquet", self.schema, 1).drop("_source_file")


def run(stream, folder):
    drain(to_files(stream, f"{folder}/out", f"{folder}/checkpoint"))
    return stream.sparkSession.read.parquet(f"{folder}/out")


def ticks(spark, *times):
    return spark.createDataFrame([(f"c{i}", t) for i, t in enumerate(times)], "transaction_id string, t string").select(
        "transaction_id", F.lit("C").alias("customer_id"), F.lit("M").alias("merchant_id"),
        F.lit(1.0).alias("amount"), F.col("t").cast("timestamp").alias("event_timestamp"))


def test_late_rows_are_dropped_by_windows_but_not_by_projections(spark, folder):
    feed = Feed(spark, folder, ticks(spark, "2024-01-01 00:00:00").schema)
    for times in (["2024-01-01 10:05:00"], ["2024-01-01 15:00:00"], ["2024-01-01 16:00:00"],
                  ["2024-01-01 10:10:00"], ["2024-01-01 23:00:00"]):
        feed.deliver(ticks(spark, *times))
    stream = feed.stream().withWatermark("event_timestamp", "30 minutes")
    windows = run(windowed_activity(stream), f"{folder}/w").collect()
    assert {r.window_start.hour: r.txn_count for r in windows} == {10: 1, 15: 1, 16: 1}
    assert run(feed.stream().select("transaction_id"), f"{folder}/p").count() == 5


def test_windows_count_distinct_merchants_closely(spark, folder):
    rows = spark.range(2000).select(
        F.col("id").cast("string").alias("transaction_id"), F.lit("C").alias("customer_id"),
        (F.col("id") % 500).cast("string").alias("merchant_id"), F.lit(1.0).alias("amount"),
        F.expr("timestamp'2024-01-01 10:00:00' + make_interval(0,0,0,0,0,0,id)").alias("event_timestamp"))
    feed = Feed(spark, folder, rows.schema)
    feed.deliver(rows)
    feed.deliver(rows.limit(1).withColumn("event_timestamp", F.expr("timestamp'2024-01-02 00:00:00'")))
    row = run(windowed_activity(feed.stream().withWatermark("event_timestamp", "30 minutes")), folder).first()
    assert row.txn_count == 2000 and row.total_amount == 2000.0
    assert abs(row.approx_merchants - 500) < 50


def test_dedup_within_watermark_over_batches(spark, folder):
    rows = ticks(spark, "2024-01-01 10:00:00", "2024-01-01 10:01:00")
    feed = Feed(spark, folder, rows.schema)
    for _ in range(3):
        feed.deliver(rows)
    stream = feed.stream().withWatermark("event_timestamp", "30 minutes")
    assert run(drop_duplicates(stream, ["transaction_id"], watermark=True), folder).count() == 2


def test_landed_path_as_stream_equals_batch(spark, folder):
    rows = inputs.landing(spark, SF)
    feed = Feed(spark, folder, rows.schema)
    for _ in range(2):
        feed.deliver(rows)
    columns = ["transaction_id", "amount_usd", "risk_band", "_processing_path"]
    landed = bronze.transactions_landed(feed.stream())
    streamed = run(silver.transactions_landed_cleaned(landed, inputs.AS_OF).select(columns), folder)
    batch = silver.transactions_landed_cleaned(bronze.transactions_landed(rows), inputs.AS_OF).select(columns)
    assert streamed.count() == batch.count() and streamed.exceptAll(batch).count() == 0


def test_tracked_rules_appear_in_the_progress(spark, folder):
    rows = txns(spark, {}, dict(amount=-1.0), dict(amount=None))
    feed = Feed(spark, folder, rows.schema)
    feed.deliver(rows)
    query = to_files(quality.track_stream(feed.stream(), quality.BRONZE_RULES, "bronze"), f"{folder}/o", f"{folder}/c")
    drain(query)
    counts = [p.observedMetrics["bronze"] for p in query.recentProgress if "bronze" in (p.observedMetrics or {})]
    assert sum(c["amount_positive"] for c in counts) == 2


def test_bronze_stream_reports_its_rules(spark, folder):
    rows = inputs.landing(spark, SF).limit(10).withColumn("customer_id", F.lit(None).cast("string"))
    feed = Feed(spark, folder, rows.schema)
    feed.deliver(rows)
    query = to_files(bronze.transactions_landed(feed.stream()), f"{folder}/o", f"{folder}/c")
    drain(query)
    seen = [p.observedMetrics["bronze_transactions_landed"]["customer_id_present"] for p in query.recentProgress
            if p.observedMetrics]
    assert sum(seen) == 10


def test_union_of_two_streams(spark, folder):
    rows = ticks(spark, "2024-01-01 10:00:00")
    live, landed = Feed(spark, f"{folder}/a", rows.schema), Feed(spark, f"{folder}/b", rows.drop("merchant_id").schema)
    live.deliver(rows)
    landed.deliver(rows.drop("merchant_id"))
    both = run(silver.transactions_unified(live.stream(), landed.stream()), folder)
    assert both.count() == 2 and both.filter("merchant_id is null").count() == 1


# ---- keyed state --------------------------------------------------------------------------------


def test_failed_batch_is_replayed_without_double_effect(spark, folder):
    schema = "id string, seq int, a string"
    feed = Feed(spark, folder, spark.createDataFrame([], schema).schema)
    feed.deliver(spark.createDataFrame([("k", 1, "a1")], schema))
    feed.deliver(spark.createDataFrame([("k", 2, None), ("m", 1, "b1")], schema))
    upsert = Scd1Stream(feed.stream(), folder, ["id"], ["seq"], exclude=["seq"])
    seen = []

    def lose_the_driver(rows, batch_id):
        seen.append((batch_id, sorted(map(tuple, rows.collect()))))
        if len(seen) == 2:
            raise RuntimeError("driver lost")

    with pytest.raises(Exception, match="driver lost"):
        drain(upsert.start(publish=lose_the_driver))
    drain(upsert.start(publish=lose_the_driver))
    assert seen == [(0, [("k", "a1")]), (1, [("k", "a1"), ("m", "b1")]), (1, [("k", "a1"), ("m", "b1")])]
    assert sorted(map(tuple, upsert.table().collect())) == [("k", "a1"), ("m", "b1")]


def state_reads(query):
    """Rows that the state operators of each micro-batch wrote, and how many they hold."""
    return [(p.numInputRows, s.numRowsUpdated, s.numRowsTotal) for p in query.recentProgress for s in p.stateOperators]


def test_a_batch_touches_only_the_state_of_its_keys(spark, folder):
    schema = "id string, seq int, a string"
    feed = Feed(spark, folder, spark.createDataFrame([], schema).schema)
    many = spark.range(5000).select(F.concat(F.lit("k"), "id").alias("id"), F.lit(1).alias("seq"), F.lit("a").alias("a"))
    feed.deliver(many)
    Scd1Stream(feed.stream(), f"{folder}/1", ["id"], ["seq"]).run()
    Scd2Stream(feed.stream(), f"{folder}/2", ["id"], ["seq"], ["a"]).run()
    feed.deliver(spark.createDataFrame([("k7", 2, "b"), ("new", 1, "c")], schema))
    for upsert in (Scd1Stream(feed.stream(), f"{folder}/1", ["id"], ["seq"]), Scd2Stream(feed.stream(), f"{folder}/2", ["id"], ["seq"], ["a"])):
        query = upsert.start()
        drain(query)
        touched = [(updated, total) for rows, updated, total in state_reads(query) if rows == 2]
        assert touched and all(updated <= 4 and total >= 5001 for updated, total in touched)


def shuffle_files(spark):
    blocks = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllBlocks()
    return {name for name in blocks.mkString(",").split(",") if name.startswith("shuffle_")}


def test_a_micro_batch_leaves_no_shuffle_files(spark, folder):
    """Also where what it changed is read more than once."""
    rows = spark.range(2000).select((F.col("id") % 700).alias("id"), F.col("id").alias("seq"), F.lit("a").alias("a"))
    feed = Feed(spark, folder, rows.schema)
    for i in range(4):
        feed.deliver(rows.filter(F.col("seq") % 4 == i))
    before, seen = shuffle_files(spark), []
    upsert = Scd1Stream(feed.stream(), folder, ["id"], ["seq"])
    drain(upsert.start(publish=lambda changed, _: seen.append((changed.count(), changed.distinct().count(), len(changed.collect())))))
    until = time.time() + 20
    while (left := shuffle_files(spark) - before) and time.time() < until:
        time.sleep(0.2)
    assert len(seen) == 4 and all(a == b == c for a, b, c in seen) and not left
    assert upsert.table().count() == 700


def test_keyed_state_takes_little_disk(spark, folder):
    """Bytes for a row of forty columns, in the checkpoint and in RocksDB."""
    rows = spark.range(0, 4000, 1, 1).select(
        "id", F.col("id").alias("seq"), *[F.concat(F.lit(f"value {i} "), F.col("id") % 50).alias(f"c{i}") for i in range(40)])
    feed = Feed(spark, folder, rows.schema)
    feed.deliver(rows)
    upsert = Scd1Stream(feed.stream(), folder, ["id"], ["seq"])
    upsert.run()
    logged = sum(path.stat().st_size for path in Path(f"{folder}/checkpoint/state").rglob("*.changelog"))
    assert 0 < logged < 100 * 4000
    assert upsert.table().exceptAll(rows).count() == 0 and upsert.table().count() == 4000


def test_scd1_stream_with_deletes_equals_batch(spark, folder):
    rows = spark.range(300).select(
        F.concat(F.lit("k"), (F.col("id") % 7).cast("string")).alias("id"), F.col("id").alias("seq"),
        F.when(F.col("id") % 3 != 0, F.col("id").cast("string")).alias("a"), (F.col("id") % 11 == 0).alias("gone"))
    feed = Feed(spark, folder, rows.schema)
    for i in (2, 0, 3, 1):
        feed.deliver(rows.filter(F.pmod(F.xxhash64("seq"), F.lit(4)) == i))
    options = dict(exclude=["seq", "gone"], delete_when=F.col("gone"))
    upsert = Scd1Stream(feed.stream(), folder, ["id"], ["seq"], **options)
    drain(upsert.start())
    batch = scd1(rows, ["id"], ["seq"], **options)
    assert sorted(map(tuple, upsert.table().collect())) == sorted(map(tuple, batch.collect()))


def test_late_record_splits_a_version(spark, folder):
    schema = "id string, seq int, a string"
    feed = Feed(spark, folder, spark.createDataFrame([], schema).schema)
    feed.deliver(spark.createDataFrame([("k", 1, "A"), ("k", 5, "A")], schema))
    upsert = Scd2Stream(feed.stream(), folder, ["id"], ["seq"], ["a"])
    drain(upsert.start())
    assert upsert.history().count() == 1
    feed.deliver(spark.createDataFrame([("k", 3, "B")], schema))
    drain(Scd2Stream(feed.stream(), folder, ["id"], ["seq"], ["a"]).start())
    got = sorted((r.valid_from, r.valid_to, r.a) for r in upsert.history().collect())
    assert got == [(1, 3, "A"), (3, 5, "B"), (5, None, "A")]


@pytest.mark.parametrize("policy", [SkewPolicy(), SkewPolicy(hot_rows=4)], ids=["plain", "hot"])
def test_scd2_stream_equals_batch_in_any_order(spark, folder, policy):
    """Some keys arrive in order, some late, some are deleted; one key has most of the records."""
    rows = spark.range(160).select(
        F.when(F.col("id") % 3 == 0, F.concat(F.lit("k"), (F.col("id") % 5).cast("string")))
        .otherwise(F.when(F.col("id") % 20 == 1, None).otherwise("hot")).alias("key"),
        F.col("id").alias("seq"),
        F.pmod(F.xxhash64(F.col("id") / 4), F.lit(3)).alias("a"), F.col("id").cast("string").alias("b"),
        (F.col("id") % 23 == 5).alias("gone"))
    feed = Feed(spark, folder, rows.schema)
    for low in range(0, 160, 40):
        late = (F.col("key") == "k0") & F.col("seq").between(40, 60)
        period = F.col("seq").between(low, low + 39)
        feed.deliver(rows.filter(F.when(F.coalesce(late, F.lit(False)), F.lit(low == 120)).otherwise(period)))
    upsert = Scd2Stream(feed.stream(), folder, ["key"], ["seq"], ["a"], policy, F.col("gone"))
    drain(upsert.start())
    batch = scd2(rows, ["key"], ["seq"], ["a"], delete_when=F.col("gone"))
    assert sorted(map(str, upsert.history().collect())) == sorted(map(str, batch.collect()))


def test_scd2_stream_keeps_each_record_under_a_key_of_its_own(spark, folder):
    """Records of one key, some of them twice and some without a sequence, over several micro-batches."""
    rows = spark.range(300).select(
        F.lit("hot").alias("key"), F.when(F.col("id") % 50 != 7, F.col("id")).alias("seq"), F.col("id").alias("number"),
        (F.col("id") % 7).alias("a"))
    feed = Feed(spark, folder, rows.schema)
    for i in (2, 0, 1):
        feed.deliver(rows.filter(F.pmod(F.xxhash64("number"), F.lit(3)) == i))
    feed.deliver(rows.filter("number % 10 = 3"))
    upsert = Scd2Stream(feed.stream(), folder, ["key"], ["seq", "number"], ["a"])
    query = upsert.start()
    drain(query)
    states = [s for p in query.recentProgress for s in p.stateOperators]
    assert states[-1].numRowsTotal == 300 and all(s.operatorName == "dedupe" for s in states)
    batch = scd2(rows, ["key"], ["seq", "number"], ["a"])
    assert sorted(map(str, upsert.history().collect())) == sorted(map(str, batch.collect()))
    assert upsert.kept_rows().count() == 300 and upsert.late().count() == 0


@pytest.mark.parametrize("groups", [None, 7])
def test_travel_pairs_across_batches(spark, folder, groups):
    rows = inputs.transactions(spark, SF).select("customer_id", "amount", *gold.TRAVEL_STATE)
    params = RiskParams(as_of=inputs.AS_OF)
    feed = Feed(spark, folder, rows.schema)
    for low in range(1, 31, 6):
        feed.deliver(rows.filter(F.dayofmonth("event_timestamp").between(low, low + 5)))
    travel = TravelStream(feed.stream(), folder, params, groups=groups)
    drain(travel.start())
    batch = gold.impossible_travel(rows, params).drop("detected_at")
    found = travel.found().drop("detected_at")
    assert found.count() == batch.count() and found.exceptAll(batch).count() == 0


def journey(spark, *rows):
    """Transactions of (id, customer, time, latitude)."""
    columns = "transaction_id string, customer_id string, t string, latitude double"
    return spark.createDataFrame(list(rows), columns).select(
        "customer_id", F.lit(1.0).alias("amount"), F.col("t").cast("timestamp").alias("event_timestamp"), "latitude",
        F.lit(77.0).alias("longitude"), F.lit("X").alias("location_city"), F.lit("IN").alias("location_country"),
        "transaction_id")


def pairs(found):
    return sorted((r.txn_id_1, r.txn_id_2) for r in found.collect())


@pytest.mark.parametrize("policy", [SkewPolicy(), SkewPolicy(hot_rows=2)], ids=["plain", "hot"])
def test_travel_waits_for_late_transactions(spark, folder, policy):
    day = "2024-01-01 "
    deliveries = [
        [("a1", "A", day + "08:00:00", 10.0), ("a3", "A", day + "08:20:00", 30.0), ("n1", None, day + "08:00:00", 10.0)],
        # Out of order, but within the lateness; without a customer; without a time; a full copy.
        [("a2", "A", day + "08:10:00", 20.0), ("n2", None, day + "08:15:00", 20.0), ("x", "A", None, 50.0),
         ("a3", "A", day + "08:20:00", 30.0)],
        [("b1", "B", day + "12:00:00", 10.0)],
        # Behind the watermark of 11:30.
        [("a0", "A", day + "08:05:00", 70.0), ("a4", "A", day + "11:40:00", 10.0)],
        [],
    ]
    feed = Feed(spark, folder, journey(spark, *deliveries[0]).schema)
    params = RiskParams(as_of="2024-01-02 00:00:00")
    expected = [("a1", "a2"), ("a2", "a3"), ("n1", "n2")]
    for i, rows in enumerate(deliveries):
        feed.deliver(journey(spark, *rows))
        travel = TravelStream(feed.stream(), folder, params, policy)
        drain(travel.start())
        if i == 1:
            assert pairs(travel.settled()) == [] and pairs(travel.found()) == expected
        if i >= 2:
            assert pairs(travel.settled()) == expected
    assert pairs(travel.found()) == [*expected[:2], ("a3", "a4"), expected[2]]
    assert [r.transaction_id for r in travel.late().collect()] == ["a0"]
    on_time = journey(spark, *(r for rows in deliveries for r in rows if r[0] != "a0"))
    assert pairs(gold.impossible_travel(on_time, params)) == pairs(travel.found())


def test_strangers_can_be_left_out(spark, folder):
    rows = journey(spark, ("n1", None, "2024-01-01 08:00:00", 10.0), ("n2", None, "2024-01-01 08:15:00", 20.0),
                   ("a1", "A", "2024-01-01 08:00:00", 10.0), ("a2", "A", "2024-01-01 08:15:00", 20.0))
    params = RiskParams(as_of="2024-01-02 00:00:00", travel_unknown_customers=False)
    feed = Feed(spark, folder, rows.schema)
    feed.deliver(rows)
    travel = TravelStream(feed.stream(), folder, params)
    travel.run()
    assert pairs(travel.found()) == pairs(gold.impossible_travel(rows, params)) == [("a1", "a2")]


def test_scd2_stream_settles_versions_behind_the_watermark(spark, folder):
    schema = "id string, at timestamp, a string"

    def records(*rows):
        return spark.createDataFrame(list(rows), "id string, at string, a string").withColumn("at", F.col("at").cast("timestamp"))

    day = "2024-01-0"
    deliveries = [
        [("k", day + "1", "A"), ("k", day + "3", "B"), ("m", day + "1", "A")],
        [("k", day + "2", "B"), ("m", day + "4", "A"), ("k", None, "Z")],  # out of order, within the lateness
        [("z", day + "9", "A")],
        [("k", day + "5", "C"), ("m", day + "9", "C"), ("m", day + "8", "B")],  # the first lies behind the watermark
        [("k", day + "9", "B")],
    ]
    feed = Feed(spark, folder, spark.createDataFrame([], schema).schema)
    for rows in deliveries:
        feed.deliver(records(*rows))
        upsert = Scd2Stream(feed.stream(), folder, ["id"], ["at"], ["a"], lateness="2 days")
        upsert.run()
    late = {("k", "C"), ("k", "Z")}
    assert {(r.id, r.a) for r in upsert.late().collect()} == late
    on_time = records(*(r for rows in deliveries for r in rows if (r[0], r[2]) not in late))
    batch = scd2(on_time, ["id"], ["at"], ["a"])
    assert sorted(map(str, upsert.history().collect())) == sorted(map(str, batch.collect()))
    ended = upsert._written("version").collect()
    assert {(r.id, r.a) for r in ended} == {("k", "A")}  # timers ended it, though nothing new came for the key
    assert upsert.kept_rows().filter("id = 'k'").count() <= 2


def test_deliveries_of_any_size_are_one_micro_batch_each(spark, folder, monkeypatch):
    monkeypatch.setattr(streams, "FILE_ROWS", 100)
    rows = spark.range(1500).select(F.col("id").cast("string").alias("id"), F.lit(None).cast("string").alias("empty"))
    parts = [(rows.filter("id < 950"), 950), (rows.filter("id = 950"), 1), (rows.filter("false"), 0), (rows.filter("id > 950"), 549)]
    files = streams._deliver(parts, f"{folder}/in")
    feed = stream_files(spark, f"{folder}/in", "parquet", rows.schema, files)
    seen = []
    drain(to_batches(feed, lambda df, i: seen.append(df.count()), f"{folder}/c"))
    assert files == 10 and seen == [950, 1, 0, 549]


def test_a_shuffled_feed_takes_few_micro_batches_of_small_files(spark, folder, monkeypatch):
    monkeypatch.setattr(streams, "FILE_ROWS", 20)
    rows = spark.range(0, 3000, 1, 4).select("id", F.lit("x").alias("a"))
    seen = []
    drain(to_batches(streams._shuffled_feed(rows, folder, "id"), lambda df, i: seen.append(df.count()), f"{folder}/c"))
    assert sum(seen) == 3000 and 2 <= len(seen) <= 7 and max(seen) <= 4 * 8 * 20


def test_one_alert_per_transaction(spark, folder):
    deliveries = [
        [dict(transaction_id="A", is_fraud=False), dict(transaction_id="B", is_fraud=True, fraud_score=0.7)],
        [dict(transaction_id="A", is_fraud=True, fraud_score=0.8), dict(transaction_id="B", is_fraud=True, fraud_score=0.9)],
        [dict(transaction_id="A", is_fraud=True, fraud_score=0.95)],
    ]
    feed = Feed(spark, folder, txns(spark, {}).schema)
    for rows in deliveries:
        feed.deliver(txns(spark, *rows))
    alerts = run(alerts_once(feed.stream().withWatermark("event_timestamp", "30 minutes")), folder)
    assert {(r.transaction_id, r.fraud_score) for r in alerts.collect()} == {("A", 0.8), ("B", 0.7)}


def test_alert_stream_stops_on_a_negative_score(spark, folder):
    rows = txns(spark, dict(is_fraud=True, fraud_score=0.7))
    feed = Feed(spark, folder, rows.schema)
    feed.deliver(rows)
    params = RiskParams(alert_min_score=-1)
    feed.deliver(txns(spark, dict(is_fraud=True, fraud_score=-0.5)))
    with pytest.raises(Exception, match="no_negative_fraud_score"):
        run(gold.fraud_alerts(feed.stream(), params), folder)
    assert spark.read.parquet(f"{folder}/out").count() == 1


def test_batches_can_be_written_elsewhere(spark, folder):
    feed = Feed(spark, folder, spark.range(1).schema)
    feed.deliver(spark.range(3))
    seen = []
    drain(to_batches(feed.stream(), lambda df, i: seen.append((i, df.count())), f"{folder}/c"))
    assert seen == [(0, 3)]


def test_shared_dir_follows_the_setting(spark):
    assert shared_dir(spark, "x").startswith(spark.conf.get("spark.checkpoint.dir"))
    assert shared_dir(spark, "x") != shared_dir(spark, "x")
