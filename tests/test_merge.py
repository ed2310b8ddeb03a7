"""Tables that take deliveries."""

import uuid

import pytest
from pyspark.sql import functions as F

from veriflux.operators.cdc import scd1, scd2
from veriflux.operators.merge import PART, Scd1Table, Scd2Table, buckets_for
from veriflux.operators.ordered import SkewPolicy


@pytest.fixture
def name():
    return f"t_{uuid.uuid4().hex}"


def changes(spark, n=400):
    return spark.range(n).select(
        F.when(F.col("id") % 41 != 0, F.concat(F.lit("k"), (F.col("id") % 37).cast("string"))).alias("key"),
        F.col("id").cast("int").alias("seq"), F.pmod(F.xxhash64(F.col("id") / 60), F.lit(3)).alias("a"),
        F.when(F.col("id") % 5 != 0, F.col("id").cast("string")).alias("b"), (F.col("id") % 23 == 5).alias("gone"))


def deliveries(rows):
    """Out of order, the third one twice."""
    return [rows.filter(F.pmod(F.xxhash64("seq"), F.lit(4)) == k) for k in (2, 0, 3, 3, 1)]


def as_text(df):
    return sorted(map(str, df.select(sorted(df.columns)).collect()))


def test_scd1_table_equals_batch(spark, name, folder):
    rows = changes(spark)
    options = dict(exclude=["seq", "gone"], delete_when=F.col("gone"))
    table = Scd1Table(spark, name, ["key"], ["seq"], parts=5, buckets=4, path=folder, **options)
    for part in deliveries(rows):
        table.apply(part)
    table.apply(rows.limit(0))
    keyed = rows.filter("key is not null")
    assert as_text(table.table()) == as_text(scd1(keyed, ["key"], ["seq"], **options))
    assert as_text(table.quarantine().distinct()) == as_text(rows.filter("key is null"))


def test_scd2_table_equals_batch(spark, name, folder):
    rows = changes(spark)
    table = Scd2Table(spark, name, ["key"], ["seq"], ["a"], delete_when=F.col("gone"), parts=5, buckets=4, path=folder)
    for part in deliveries(rows):
        table.apply(part)
    batch = as_text(scd2(rows.filter("key is not null"), ["key"], ["seq"], ["a"], delete_when=F.col("gone")))
    assert as_text(table.history()) == batch
    table.rebuild([0, 3])
    assert as_text(table.history()) == batch


def files(spark, name):
    return {r.f for r in spark.table(name).select(F.input_file_name().alias("f"), PART).distinct().collect()}


def test_only_touched_parts_are_rewritten(spark, name, folder):
    rows = changes(spark).filter("key is not null")
    table = Scd2Table(spark, name, ["key"], ["seq"], ["a"], parts=8, buckets=2, path=folder)
    table.apply(rows)
    before = files(spark, name)
    one = rows.filter("key = 'k3'").withColumn("seq", F.col("seq") + 1000)
    parts = table.runs.touched(one)
    table.apply(one)
    gone = before - files(spark, name)
    assert len(parts) == 1 and gone and all(f"{PART}={parts[0]}/" in f for f in gone)


def exchanges_above_scans(df):
    """For each file scan of the plan whether an exchange of rows lies above it (below the join)."""
    plan = df._jdf.queryExecution().executedPlan().toString()
    out, path = [], []
    for line in plan.splitlines():
        node = line.lstrip(" :+-*(0123456789)")
        depth = len(line) - len(line.lstrip(" :+-"))
        path = [(d, n) for d, n in path if d < depth] + [(depth, node)]
        if node.startswith("FileScan"):
            out.append(any(n.startswith("Exchange") for _, n in path))
    return out


def test_the_stored_side_is_not_shuffled(spark, name, folder):
    rows = changes(spark).filter("key is not null")
    first = Scd1Table(spark, name, ["key"], ["seq"], exclude=["seq"], parts=4, buckets=4, path=f"{folder}/1")
    second = Scd2Table(spark, f"{name}_2", ["key"], ["seq"], ["a"], parts=4, buckets=4, path=f"{folder}/2")
    first.apply(rows)
    second.apply(rows)
    fresh = spark.createDataFrame(rows.limit(50).collect(), rows.schema)
    keys = second.touched_keys(fresh)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        for df in (first.merged(fresh, [0, 2]), second.known(keys, [0, 2]), second.untouched(keys, [0, 2])):
            assert exchanges_above_scans(df) == [False], df._jdf.queryExecution().executedPlan().toString()
            assert "Exchange" in df._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_versions_of_a_delivery_take_one_task_for_each_bucket(spark, name, folder):
    rows = changes(spark).filter("key is not null")
    table = Scd2Table(spark, name, ["key"], ["seq"], ["a"], SkewPolicy(hot_rows=None), parts=2, buckets=16, path=folder)
    table.apply(rows)
    fresh = table._prepare(spark.createDataFrame(rows.limit(50).collect(), rows.schema))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        assert table.derived(table.touched_keys(fresh), [0, 1], fresh).rdd.getNumPartitions() == 16
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.enabled")
    assert (buckets_for(spark, 10), buckets_for(spark, 54_000_000)) == (8, 270)
