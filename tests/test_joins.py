"""Joins against sides that are too large to broadcast, and against rates that move."""

from pyspark.sql import functions as F

from veriflux.operators.sizing import hot_keys, lookup_left
from veriflux.sources.files import stream_files
from veriflux.streaming.rates import with_usd_amount
from veriflux.streaming.run import drain, to_files


def facts(spark):
    return spark.range(2000).select(
        F.col("id").alias("n"), F.when(F.col("id") % 4 != 0, "hot").when(F.col("id") % 50 == 0, None)
        .otherwise(F.concat(F.lit("k"), (F.col("id") % 300).cast("string"))).alias("key"))


def rates_of(spark):
    return spark.range(400).select(F.concat(F.lit("k"), "id").alias("name"), F.col("id").alias("v")).unionByName(
        spark.createDataFrame([("hot", -1)], "name string, v long"))


def test_heavy_hitters_are_found(spark):
    assert list(hot_keys(facts(spark), ["key"], 500).values()) == [3]
    assert hot_keys(facts(spark).limit(0), ["key"], 500) == {}


def test_only_hot_keys_are_copied(spark):
    joined = lookup_left(facts(spark), rates_of(spark), [("key", "name")], "n", max_rows=0, rows_per_task=100)
    assert "name" not in joined.columns and joined.columns == ["n", "key", "v"]
    plain = facts(spark).join(rates_of(spark), F.col("key") == F.col("name"), "left").drop("name")
    assert sorted(map(str, joined.collect())) == sorted(map(str, plain.collect()))
    plan = joined._jdf.queryExecution().optimizedPlan()
    copies = [n for n in _nodes(plan) if n.nodeName() == "Generate"]
    assert len(copies) == 1
    copied = spark._jvm.org.apache.spark.sql.classic.Dataset.ofRows(spark._jsparkSession, copies[0])
    assert copied.count() == 400 + 15  # 1,500 rows of the hot key, a hundred for each copy


def _nodes(plan):
    yield plan
    children = plan.children()
    for i in range(children.size()):
        yield from _nodes(children.apply(i))


def test_types_of_both_sides_may_differ(spark):
    left = spark.range(500).select(F.lit(7).cast("int").alias("key"), "id")
    right = spark.createDataFrame([(7, "x")], "name long, v string")
    assert lookup_left(left, right, [("key", "name")], "id", max_rows=0, rows_per_task=50).filter("v = 'x'").count() == 500


def test_moving_rates(spark, folder):
    """A transaction waits for its rate; a correction counts; a foreign amount without a rate is marked."""
    day = "2024-01-0"
    rows = [
        [("a", "EUR", 10.0, day + "1 10:00:00"), ("n", "EUR", 1.0, None), ("c", None, 1.0, day + "1 10:00:00")],
        [("b", "CHF", 10.0, day + "1 11:00:00"), ("w", "EUR", 5.0, day + "9 11:00:00")],
        [("z", "EUR", 1.0, "2024-02-01 00:00:00")],
    ]
    rates = [
        [("EUR", day + "2", 9.0, 1)],
        [("EUR", day + "1", 2.0, 1), ("EUR", day + "1", None, 3)],
        [("EUR", day + "1", 3.0, 2), ("EUR", day + "9", 4.0, 1), ("EUR", "2024-02-01", 1.0, 1)],
    ]
    for part in rows:
        df = spark.createDataFrame(part, "transaction_id string, currency string, amount double, t string")
        df.withColumn("event_timestamp", F.col("t").cast("timestamp")).coalesce(1).write.mode("append").parquet(f"{folder}/t")
    for part in rates:
        df = spark.createDataFrame(part, "currency_code string, d string, usd_multiplier double, _ingested_at int")
        df.withColumn("rate_date", F.col("d").cast("date")).coalesce(1).write.mode("append").parquet(f"{folder}/r")
    feeds = [stream_files(spark, f"{folder}/{k}", "parquet", spark.read.parquet(f"{folder}/{k}").schema, 1) for k in "tr"]
    drain(to_files(with_usd_amount(*feeds, patience="10 days", salts=3), f"{folder}/out", f"{folder}/checkpoint"))
    got = {r.transaction_id: (r.amount_usd, r.rate_missing) for r in spark.read.parquet(f"{folder}/out").collect()}
    assert got == {"a": (30.0, False), "b": (None, True), "n": (None, True), "c": (None, True), "w": (20.0, False)}
