"""Neighbours and running values with hot keys cut into slices."""

import random

import pytest
from pyspark.sql import functions as F

from conftest import SF
from veriflux.operators.ordered import HotKeys, OrderedRows, SkewPolicy
from veriflux.params import RiskParams
from veriflux.plans import gold
from workload import inputs

HOT = SkewPolicy(hot_rows=20)
HOT_BY_SHUFFLE = SkewPolicy(hot_rows=20, max_broadcast_rows=0)


def feed(spark):
    """Key 'h' holds most rows, in clumps; a null key is hot as well; some order values are null or tied."""
    rng = random.Random(5)
    rows = [("h", 1000.0 * (i // 50) + (i % 50) // 2, i, rng.choice([None, i])) for i in range(400)]
    rows += [(None, float(i), i, i) for i in range(70)]
    rows += [(f"k{i % 9}", float(i), i, i) for i in range(60)]
    rows += [("h", None, 1000 + i, 5) for i in range(3)]
    rng.shuffle(rows)
    return rows, spark.createDataFrame(rows, "key string, at double, id int, v int").repartition(7)


def brute_force(rows):
    out = {}
    for key in {r[0] for r in rows}:
        ordered = sorted((r for r in rows if r[0] == key), key=lambda r: (r[1] is not None, r[1] or 0, r[2]))
        last = None
        for i, (_, _, ident, v) in enumerate(ordered):
            last = v if v is not None else last
            before = ordered[i - 1][2] if i else None
            after = ordered[i + 1][2] if i + 1 < len(ordered) else None
            out[key, ident] = (before, after, last)
    return out


@pytest.mark.parametrize("policy", [SkewPolicy(), HOT, HOT_BY_SHUFFLE], ids=["plain", "hot", "hot-shuffled"])
def test_neighbours_and_running_last(spark, policy):
    rows, df = feed(spark)
    ordered = OrderedRows(df, ["key"], ["at", "id"], policy)
    result = ordered.previous(["id"]).following(["id"]).running_last("v", "last_v").result()
    got = {(r.key, r.id): (r.prev_id, r.next_id, r.last_v) for r in result.collect()}
    assert got == brute_force(rows)
    assert result.columns == ["key", "at", "id", "v", "prev_id", "next_id", "last_v"]


def test_slices_are_small_and_ordered(spark):
    df = spark.range(10000).select(F.lit("h").alias("key"), F.timestamp_seconds("id").alias("at"))
    policy = SkewPolicy(hot_rows=500)
    hot = HotKeys.find(df, ["key"], "at", policy)
    sizes = hot.slice(df, ["key"], "at").groupBy("_slice").agg(F.count("*").alias("n"), F.min("at").alias("lo"))
    rows = sizes.orderBy("_slice").collect()
    assert len(rows) == 20 and max(r.n for r in rows) <= 501
    assert [r.lo for r in rows] == sorted(r.lo for r in rows)


def test_sampled_count_gives_the_same_rows(spark):
    """Bounds from a sample miss the first and last rows of a key; the result must not."""
    df = spark.range(60000).select(
        F.when(F.col("id") % 3 == 0, F.col("id") % 50).otherwise(-1).alias("key"),
        F.timestamp_seconds(F.pmod(F.xxhash64("id"), F.lit(1000000))).alias("at"), "id")
    policy = SkewPolicy(hot_rows=4000)
    hot = HotKeys.find(df, ["key"], "at", policy)
    assert [r._hot_key for r in hot.table.collect()] == [-1]
    assert hot.slice(df, ["key"], "at").filter("_slice is not null").groupBy("_slice").count().agg(
        F.max("count")).first()[0] < 5000
    plain = OrderedRows(df, ["key"], ["at", "id"]).previous(["id"]).running_last("id", "last").result()
    sliced = OrderedRows(df, ["key"], ["at", "id"], policy).previous(["id"]).running_last("id", "last").result()
    assert plain.exceptAll(sliced).count() == 0 and sliced.count() == 60000


def test_no_hot_key_leaves_the_plain_window(spark):
    _, df = feed(spark)
    assert HotKeys.find(df, ["key"], "at", SkewPolicy()) is None
    plan = OrderedRows(df, ["key"], ["at", "id"]).previous(["id"]).result()._jdf.queryExecution().toString()
    assert "_slice" not in plan


def test_travel_with_hot_customers(spark):
    rows = inputs.transactions(spark, SF)
    params = RiskParams(as_of=inputs.AS_OF)
    plain = gold.impossible_travel(rows, params).drop("detected_at")
    sliced = gold.impossible_travel(rows, params, HOT).drop("detected_at")
    assert plain.count() == sliced.count()
    assert plain.exceptAll(sliced).count() == 0


def crowded(spark):
    """One key: a third of its rows share one time, a third lie within a second, the rest within a year."""
    i = F.col("id")
    micros = (
        F.when(i % 3 == 0, F.lit(0))
        .when(i % 3 == 1, F.pmod(F.xxhash64("id"), F.lit(1_000_000)))
        .otherwise(F.pmod(F.xxhash64("id"), F.lit(31_536_000_000_000)))
    )
    return spark.range(30000).select(
        F.lit("h").alias("key"), F.timestamp_micros(micros).alias("at"),
        F.concat(F.lit("TXN_"), i.cast("string")).alias("txn"), i,
    )


def test_crowded_and_tied_rows_are_cut_again(spark):
    df, policy, order = crowded(spark), SkewPolicy(hot_rows=1000), ["at", "txn"]
    hot = HotKeys.find(df, ["key"], order, policy)
    slices = hot.slice(df, ["key"], order).groupBy("_slice").agg(
        F.count("*").alias("n"), F.min(F.struct(*order)).alias("lo"), F.max(F.struct(*order)).alias("hi"),
    ).orderBy("_slice").collect()
    assert sum(s.n for s in slices) == 30000 and max(s.n for s in slices) < 3000
    assert all(a.hi < b.lo for a, b in zip(slices, slices[1:]))
    plain = OrderedRows(df, ["key"], order, SkewPolicy(hot_rows=None)).previous(["id"]).result()
    sliced = OrderedRows(df, ["key"], order, policy, hot=hot, look_for_hot=False).previous(["id"]).result()
    assert plain.exceptAll(sliced).count() == 0 and sliced.count() == 30000


def test_copies_of_a_hot_key_are_merged_on_request(spark):
    copies = crowded(spark).filter("id < 3").select("key", "at", "txn", "id", F.explode(F.sequence(F.lit(1), F.lit(2000))))
    df = crowded(spark).filter("id >= 3").unionByName(copies.drop("col"))
    policy, order = SkewPolicy(hot_rows=1000), ["at", "txn"]
    merged = OrderedRows(df, ["key"], order, policy, merge_copies=True)
    assert merged.rows.groupBy("_slice").count().agg(F.max("count")).first()[0] < 3000
    expected = OrderedRows(df.distinct(), ["key"], order, SkewPolicy(hot_rows=None)).previous(["id"]).result()
    assert expected.exceptAll(merged.previous(["id"]).result()).count() == 0


def test_travel_ignores_copies(spark):
    rows = inputs.transactions(spark, SF)
    delivered_twice = rows.unionByName(rows.filter("offset % 4 = 0")).unionByName(rows.filter("offset % 8 = 0"))
    params = RiskParams(as_of=inputs.AS_OF)
    once = gold.impossible_travel(rows, params).drop("detected_at")
    for policy in (SkewPolicy(), HOT):
        found = gold.impossible_travel(delivered_twice, params, policy).drop("detected_at")
        assert found.exceptAll(once).count() == 0 and once.exceptAll(found).count() == 0
