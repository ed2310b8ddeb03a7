"""Streaming queries: each writes its feed to a fresh shared folder, runs the stream to its end and reads
the result as a batch frame."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from veriflux.operators import quality
from veriflux.operators.cdc import drop_duplicates
from veriflux.plans import bronze, gold, silver
from veriflux.session import shared_dir
from veriflux.sources import bus
from veriflux.sources.files import stream_files
from veriflux.streaming.late import mark_late
from veriflux.streaming.live import LivePath
from veriflux.streaming.rates import with_usd_amount as with_moving_rates
from veriflux.streaming.rule_counts import RuleCounts
from veriflux.streaming.run import to_files
from veriflux.streaming.travel import TravelStream
from veriflux.streaming.upsert import Scd1Stream, Scd2Stream
from veriflux.streaming.windows import windowed_activity
from workload import inputs
from workload.batch import PARAMS, TRANSACTION_TABLE_COLUMNS
from workload.files import RUN_COLUMNS, streamed
from workload.present import present


def _feed(rows: DataFrame, folder: str, files_per_trigger: int | None = None) -> DataFrame:
    """Delivers `rows` to the folder and opens it as a stream."""
    rows.write.mode("append").parquet(f"{folder}/in")
    return stream_files(rows.sparkSession, f"{folder}/in", "parquet", rows.schema, files_per_trigger)


# Files of this many rows keep the tasks of a micro-batch small and let all cores take part in it.
FILE_ROWS = 250_000
# Feeds stay on disk beside the state for as long as a query runs; zstd takes about half the disk of Spark's default.
FEED_CODEC = "zstd"


def _files(spark: SparkSession, path: str) -> int:
    return len(spark.read.parquet(path).inputFiles())


def _shuffled_feed(rows: DataFrame, folder: str, number: str) -> DataFrame:
    """Delivers `rows` in three parts without regard to their order. A micro-batch takes two thirds of the files, and no
    more than four for each core."""
    spark = rows.sparkSession
    for part in range(3):
        writer = rows.filter(F.pmod(F.xxhash64(number), F.lit(3)) == part).write.option("maxRecordsPerFile", FILE_ROWS)
        writer.option("compression", FEED_CODEC).mode("append").parquet(f"{folder}/in")
    most = 4 * spark.sparkContext.defaultParallelism
    stream = stream_files(spark, f"{folder}/in", "parquet", rows.schema, min(most, -(-2 * _files(spark, f"{folder}/in") // 3)))
    return stream.select(*rows.columns)


def _deliver(parts: Sequence[tuple[DataFrame, int]], path: str) -> int:
    """Writes parts of known sizes, each as one delivery. All deliveries get the same number of files, which is returned:
    micro-batches of as many files hold one delivery each."""
    files = max([1, *(-(-size // FILE_ROWS) for _, size in parts)])
    for number, (rows, _) in enumerate(parts, 1):
        rows.repartition(files, *rows.columns).write.mode("append").parquet(path)
        while _files(rows.sparkSession, path) < number * files:
            rows.limit(0).coalesce(1).write.mode("append").parquet(path)
    return files


def _transactions(spark: SparkSession, sf: str, folder: str) -> DataFrame:
    return bronze.transactions_landed(_feed(inputs.landing(spark, sf), folder))


def stream_alerts(spark: SparkSession, sf: str) -> DataFrame:
    folder = shared_dir(spark, "alerts")
    return present(streamed(gold.fraud_alerts(_transactions(spark, sf, folder), PARAMS), folder))


def live_path(spark: SparkSession, sf: str) -> DataFrame:
    """Messages to alerts, with what became of the other messages: current transactions and dead letters."""
    folder = shared_dir(spark, "live")
    inputs.envelopes(spark, sf).write.option("compression", FEED_CODEC).parquet(f"{folder}/in")
    live = LivePath(bus.replay(spark, f"{folder}/in"), folder, PARAMS)
    live.run()
    alert = live.alerts().select("transaction_id", F.lit("alert").alias("output"), F.col("alert_severity").alias("detail"))
    current = live.cleaned().select("transaction_id", F.lit("current").alias("output"), F.col("transaction_status").alias("detail"))
    dead = live.dead_letters().select("transaction_id", F.lit("dead").alias("output"), F.col("_quarantine_reason").alias("detail"))
    return alert.unionByName(current).unionByName(dead)


def stream_fx_join(spark: SparkSession, sf: str) -> DataFrame:
    folder = shared_dir(spark, "fx-join")
    rates = silver.exchange_rates(inputs.fx_records(spark, sf))
    rows = streamed(silver.with_usd_amount(_transactions(spark, sf, folder), rates), folder)
    return rows.select("transaction_id", "currency", "amount", "amount_usd")


def stream_fx_join_growing(spark: SparkSession, sf: str) -> DataFrame:
    """Rates come in the course of the stream, later than the transactions that need them, and are corrected once."""
    folder = shared_dir(spark, "fx-growing")
    rows, rates = inputs.landing(spark, sf), inputs.fx_records(spark, sf)
    thirds = [F.dayofmonth("transaction_date").between(low, low + 9 if low < 21 else 31) for low in (1, 11, 21)]
    sizes = rows.agg(*[F.count_if(third) for third in thirds]).first()
    files = _deliver([(rows.filter(third), size) for third, size in zip(thirds, sizes, strict=True)], f"{folder}/in")
    # A correction comes one delivery after the first rate, all rates one delivery after their transactions.
    day = F.dayofmonth("rate_date")
    for low in (-9, 1, 11, 21):
        first = (F.col("_ingested_at") == 1) & day.between(low, low + 9 if low < 21 else 31)
        second = (F.col("_ingested_at") == 2) & day.between(low - 2, low + 7 if low < 21 else 31)
        rates.filter(first | second).coalesce(1).write.mode("append").parquet(f"{folder}/rates")
    feed = bronze.transactions_landed(stream_files(spark, f"{folder}/in", "parquet", rows.schema, files))
    # A transaction waits in the state with all its columns: those that nobody asks for stay out.
    feed = feed.select("transaction_id", "currency", "amount", "event_timestamp")
    moving = stream_files(spark, f"{folder}/rates", "parquet", rates.schema, 1)
    found = streamed(with_moving_rates(feed, moving, patience="4 days"), folder)
    return found.select("transaction_id", "currency", "amount", "amount_usd", "rate_missing")


def stream_late_rows(spark: SparkSession, sf: str) -> DataFrame:
    """Every row of a feed, with whether it came behind the watermark: what windows and deduplication drop."""
    folder = shared_dir(spark, "late-rows")
    rows = inputs.transactions(spark, sf)
    feed, _ = _travel_feed(rows, folder, F.when(_held_back(), F.lit(1_000_000)).otherwise(_delivery()))
    feed = feed.select("transaction_id", "customer_id", "amount", "event_timestamp")
    found = streamed(mark_late(feed, "event_timestamp", "customer_id", TRAVEL_LATENESS), folder)
    return found.select("transaction_id", "customer_id", "amount", F.col("_late").alias("late"))


def stream_rule_counts(spark: SparkSession, sf: str) -> DataFrame:
    """The violations of all micro-batches, stored while the stream runs."""
    folder = shared_dir(spark, "rule-counts")
    rows = inputs.messy(spark, sf).withColumn("part", F.col("offset") % 3)
    rows.write.partitionBy("part").parquet(f"{folder}/in")
    feed = stream_files(spark, f"{folder}/in", "parquet", rows.schema, 1)
    checked = quality.track_stream(feed, {**quality.BRONZE_RULES, **quality.silver_rules(PARAMS.as_of)}, "silver")
    with RuleCounts(spark, f"{folder}/counts") as counts:
        counts.wait(to_files(checked.select("transaction_id"), f"{folder}/out", f"{folder}/checkpoint"))
    return counts.report().drop("name")


def stream_tumbling(spark: SparkSession, sf: str) -> DataFrame:
    folder = shared_dir(spark, "tumbling")
    rows = streamed(windowed_activity(_transactions(spark, sf, folder)), folder)
    return present(rows)


def dedup_watermark(spark: SparkSession, sf: str) -> DataFrame:
    folder = shared_dir(spark, "dedup")
    twice = inputs.landing(spark, sf).unionByName(inputs.landing(spark, sf))
    rows = bronze.transactions_landed(_feed(twice, folder))
    unique = streamed(drop_duplicates(rows, ["transaction_id"], watermark=True), folder)
    return present(unique.select(*inputs.TXN_COLUMNS), drop=RUN_COLUMNS)


def stream_scd1(spark: SparkSession, sf: str) -> DataFrame:
    folder = shared_dir(spark, "scd1")
    changes = inputs.transaction_changes(spark, sf)
    # The records of a transaction arrive out of order, spread over several micro-batches.
    feed = _shuffled_feed(changes, folder, "offset")
    exclude = [*silver.TRANSPORT_COLUMNS, "offset"]
    upsert = Scd1Stream(feed, folder, ["transaction_id"], ["offset"], exclude, unique_sequence=True)
    upsert.run()
    return present(upsert.table().select(*TRANSACTION_TABLE_COLUMNS))


def stream_scd2(spark: SparkSession, sf: str) -> DataFrame:
    folder = shared_dir(spark, "scd2")
    changes = inputs.customer_changes(spark, sf)
    feed = _shuffled_feed(changes, folder, "change_id")
    upsert = Scd2Stream(feed, folder, ["customer_id"], ["changed_at", "change_id"], silver.CUSTOMER_HISTORY)
    upsert.run()
    return present(upsert.history())


TRAVEL_LATENESS = "1 day"
# Transactions of a group of customers over the whole feed.
GROUP_ROWS = 50_000


def _travel_feed(rows: DataFrame, folder: str, delivery: Column) -> tuple[DataFrame, int]:
    """One micro-batch per delivery, and among how many groups customers are best dealt. A delivery takes ten days; a
    transaction is up to twenty hours late. Those without a time come first."""
    spark, dealt = rows.sparkSession, rows.withColumn("delivery", delivery.cast("int"))
    sizes = {r.delivery: r["count"] for r in dealt.groupBy("delivery").count().collect()}
    parts = [(dealt.filter(F.col("delivery").eqNullSafe(n)).drop("delivery"), sizes[n]) for n in sorted(sizes, key=lambda n: (n is not None, n))]
    files = _deliver(parts, f"{folder}/in")
    groups = max(int(spark.conf.get("spark.sql.shuffle.partitions")), sum(sizes.values()) // GROUP_ROWS)
    return stream_files(spark, f"{folder}/in", "parquet", rows.schema, files), groups


def _delivery() -> Column:
    hours = F.unix_micros(F.col("event_timestamp").cast("timestamp")) / 3_600_000_000
    return F.floor((hours + F.col("offset") % 5 * 5) / 240)


def _held_back() -> Column:
    return (F.substring("customer_id", 6, 20).cast("bigint") % 10 == 7) & (F.col("offset") % 3 == 0)


def stream_impossible_travel(spark: SparkSession, sf: str) -> DataFrame:
    folder = shared_dir(spark, "travel")
    feed, groups = _travel_feed(gold.recent(inputs.transactions(spark, sf), PARAMS), folder, _delivery())
    travel = TravelStream(feed, folder, PARAMS, lateness=TRAVEL_LATENESS, groups=groups)
    travel.run()
    return present(travel.found())


def stream_late_travel(spark: SparkSession, sf: str) -> DataFrame:
    """Some customers' transactions come at the very end: those behind the watermark are listed as late, with no pair."""
    folder = shared_dir(spark, "late-travel")
    rows = gold.recent(inputs.transactions(spark, sf), PARAMS)
    feed, groups = _travel_feed(rows, folder, F.when(_held_back(), F.lit(1_000_000)).otherwise(_delivery()))
    travel = TravelStream(feed, folder, PARAMS, lateness=TRAVEL_LATENESS, groups=groups)
    travel.run()
    late = travel.late().select("customer_id", F.lit(None).cast("string").alias("txn_id_1"), F.col("transaction_id").alias("txn_id_2"), F.lit(True).alias("late"))
    return travel.found().select("customer_id", "txn_id_1", "txn_id_2", F.lit(False).alias("late")).unionByName(late)


QUERIES = {
    f.__name__: f
    for f in (
        stream_alerts, live_path, stream_fx_join, stream_fx_join_growing, stream_rule_counts, stream_late_rows, stream_tumbling, dedup_watermark, stream_scd1, stream_scd2,
        stream_impossible_travel, stream_late_travel,
    )
}
