import random
from functools import reduce

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from veriflux.operators.cdc import apart, changed, current_rows, drop_duplicates, merge_winners, neighbours, scd1, scd2, winners
from veriflux.operators.ordered import OrderedRows, SkewPolicy

CHANGE = "id string, seq int, a string, b string, gone boolean"
NEVER_HOT, ALWAYS_HOT = SkewPolicy(), SkewPolicy(hot_rows=3)


def changes(spark, rows):
    return spark.createDataFrame(rows, CHANGE)


def test_nulls_do_not_overwrite_whatever_the_order(spark):
    rows = [("k", 1, "a1", "b1", False), ("k", 2, None, "b2", False), ("k", 3, "a3", None, False)]
    for _ in range(4):
        random.shuffle(rows)
        table = scd1(changes(spark, rows), ["id"], ["seq"], exclude=["seq", "gone"])
        assert [tuple(r) for r in table.collect()] == [("k", "a3", "b2")]


def test_nulls_overwrite_on_request(spark):
    rows = [("k", 1, "a1", "b1", False), ("k", 3, None, "b3", False)]
    table = scd1(changes(spark, rows), ["id"], ["seq"], exclude=["seq", "gone"], ignore_null_updates=False)
    assert [tuple(r) for r in table.collect()] == [("k", None, "b3")]


def test_deletes(spark):
    rows = [
        ("back", 1, "a1", "b1", False), ("back", 2, None, None, True), ("back", 3, "a3", None, False),
        ("away", 1, "a1", "b1", False), ("away", 2, None, None, True),
        ("late", 3, "a3", "b3", False), ("late", 2, None, None, True),
    ]
    table = scd1(changes(spark, rows), ["id"], ["seq"], ["seq", "gone"], delete_when=F.col("gone"))
    # A value from before the delete does not come back.
    assert sorted(tuple(r) for r in table.collect()) == [("back", "a3", None), ("late", "a3", "b3")]


def test_sequence_may_have_several_columns(spark):
    rows = spark.createDataFrame([("k", 1, 9, "old"), ("k", 2, 1, "new")], "id string, p int, o int, a string")
    assert scd1(rows, ["id"], ["p", "o"], exclude=["p", "o"]).first().a == "new"


def test_equal_sequences_keep_one_whole_record(spark):
    rows = [("k", 1, f"a{i}", f"b{i}", False) for i in range(20)]
    found = set()
    for _ in range(3):
        random.shuffle(rows)
        row = scd1(changes(spark, rows), ["id"], ["seq"], exclude=["seq", "gone"]).first()
        assert row.a[1:] == row.b[1:]
        found.add(row.a)
    assert len(found) == 1


def test_partial_states_merge(spark):
    rows = [(f"k{i % 3}", i, f"a{i}" if i % 4 else None, f"b{i}" if i % 5 else None, i % 7 == 0) for i in range(60)]
    whole = scd1(changes(spark, rows), ["id"], ["seq"], ["seq", "gone"], delete_when=F.col("gone"))
    parts = [winners(changes(spark, rows[i::4]), ["id"], ["seq"], ["a", "b"], delete_when=F.col("gone"))
             for i in range(4)]
    merged = parts[0]
    for part in parts[1:]:
        merged = merge_winners(merged.unionByName(part), ["id"])
    assert sorted(map(tuple, current_rows(merged, ["id"]).collect())) == sorted(map(tuple, whole.collect()))


def test_history_versions_and_untracked_columns(spark):
    rows = [("c", 1, "PENDING", "x1", False), ("c", 2, "PENDING", "x2", False), ("c", 3, None, "x3", False),
            ("c", 4, None, "x4", False), ("c", 5, "PENDING", "x5", False)]
    history = scd2(changes(spark, rows).drop("gone"), ["id"], ["seq"], track=["a"])
    got = sorted((r.valid_from, r.valid_to, r.a, r.b) for r in history.collect())
    assert got == [(1, 3, "PENDING", "x2"), (3, 5, None, "x4"), (5, None, "PENDING", "x5")]


def test_history_with_deletes(spark):
    rows = [("c", 1, "A", "x1", False), ("c", 3, None, None, True), ("c", 4, None, None, True),
            ("c", 6, "A", "x6", False), ("d", 1, "A", "y", False), ("d", 2, "A", "y", True)]
    for policy in (NEVER_HOT, ALWAYS_HOT):
        history = scd2(changes(spark, rows), ["id"], ["seq"], ["a"], policy, delete_when=F.col("gone"))
        got = sorted(((r.id, r.valid_from, r.valid_to, r.b) for r in history.collect()), key=str)
        assert got == [("c", 1, 3, "x1"), ("c", 6, None, "x6"), ("d", 1, 2, "y")]


def expected_history(rows):
    """Brute force over (id, seq, a, b)."""
    out = []
    for key in {r[0] for r in rows}:
        versions = []
        for _, seq, a, b in sorted((r for r in rows if r[0] == key), key=lambda r: r[1]):
            if versions and versions[-1][2] == a:
                versions[-1][3] = b
            else:
                versions.append([key, seq, a, b])
        ends = [v[1] for v in versions[1:]] + [None]
        out += [(k, start, end, a, b) for (k, start, a, b), end in zip(versions, ends)]
    return sorted(out, key=str)


@settings(max_examples=5, deadline=None)
@given(st.lists(st.tuples(st.sampled_from("kkkl"), st.integers(0, 200), st.sampled_from(["x", "y", None])),
                min_size=1, max_size=60, unique_by=lambda r: (r[0], r[1])))
def test_history_equals_brute_force_with_and_without_hot_keys(spark, drawn):
    rows = [(k, s, a, f"b{s}") for k, s, a in drawn]
    df = spark.createDataFrame(rows, "id string, seq int, a string, b string")
    for policy in (NEVER_HOT, ALWAYS_HOT):
        history = scd2(df, ["id"], ["seq"], ["a"], policy)
        got = sorted(((r.id, r.valid_from, r.valid_to, r.a, r.b) for r in history.collect()), key=str)
        assert got == expected_history(rows)
        # Intervals of a key join up, and exactly one is open.
        for key in {r[0] for r in rows}:
            spans = sorted((g[1], g[2]) for g in got if g[0] == key and g[2] is not None)
            starts = sorted(g[1] for g in got if g[0] == key)
            assert [e for _, e in spans] == starts[1:]


def test_changed_sees_nulls(spark):
    df = spark.createDataFrame([("a", None), (None, None), ("a", "a"), ("a", "b")], "x string, y string")
    assert [r[0] for r in df.select(changed(F.col("x"), F.col("y"))).collect()] == [True, False, False, True]


def test_dedup_keeps_the_first_by_order(spark):
    rows = [("k", i, f"a{i}", "b", False) for i in (3, 1, 2)] + [(None, 9, "n", "b", False)] * 2
    kept = drop_duplicates(changes(spark, rows), ["id"], first_by=["seq"])
    assert {(r.id, r.seq, r.a) for r in kept.collect()} == {(None, 9, "n"), ("k", 1, "a1")}
    assert kept.columns == ["id", "seq", "a", "b", "gone"]
    # The stream form has no meaning on batch frames and falls back.
    assert drop_duplicates(changes(spark, rows), ["id"], watermark=True).count() == 2


def test_hot_histories_without_copies_save_the_shuffle_that_merges_copies(spark):
    rows = changes(spark, [("k", i, "ab"[i // 3 % 2], None if i % 4 else "x", i % 7 == 0) for i in range(40)])
    ordered = OrderedRows(rows, ["id"], ["seq"], ALWAYS_HOT, merge_copies=True)
    assert not ordered.hot.tied and "Aggregate" not in ordered.rows._jdf.queryExecution().analyzed().toString()
    copied = rows.unionByName(rows.filter("seq = 5").withColumn("n", F.explode(F.sequence(F.lit(1), F.lit(30)))).drop("n"))
    merged = OrderedRows(copied, ["id"], ["seq"], ALWAYS_HOT, merge_copies=True)
    assert merged.hot.tied and merged.result().count() == 40
    for given in (rows, copied):
        hot, plain = (scd2(given, ["id"], ["seq"], ["a", "b"], policy, F.col("gone")) for policy in (ALWAYS_HOT, NEVER_HOT))
        assert sorted(map(str, hot.collect())) == sorted(map(str, plain.collect()))
    assert "_tracked" not in hot._jdf.queryExecution().analyzed().toString()


@pytest.mark.parametrize("ignore_nulls", [True, False])
def test_columns_kept_together_come_apart_as_each_on_its_own(spark, ignore_nulls):
    """Sequences that repeat or are null, nulls in any column, deletes; merged from four parts."""
    rows = spark.range(400).select(
        F.when(F.col("id") % 9 != 4, F.col("id") % 9).alias("k"), F.when(F.col("id") % 31 != 2, F.pmod(F.xxhash64("id"), F.lit(20))).alias("seq"),
        *[F.when(F.pmod(F.xxhash64("id", F.lit(c)), F.lit(4)) != 0, F.pmod(F.xxhash64(F.lit(c), "id"), F.lit(5))).alias(c) for c in "abcdef"],
        F.col("id").cast("string").alias("_run"), (F.col("id") % 23 == 5).alias("gone"))
    columns = [*"abcdef", "_run"]
    options = dict(ignore_nulls=ignore_nulls, delete_when=F.col("gone"))
    together = neighbours(columns, size=3)
    assert together == [["a", "b", "c"], ["d", "e", "f"]] and neighbours(columns, unique_sequence=True) == []
    alone = winners(rows, ["k"], ["seq"], columns, **options)
    parts = [winners(rows.filter(F.pmod("seq", F.lit(4)).eqNullSafe(i)), ["k"], ["seq"], columns, **options, together=together) for i in (3, None, 0, 2, 1)]
    merged = reduce(lambda a, b: merge_winners(a.unionByName(b), ["k"]), parts)
    found = apart(merged, together)
    assert found.columns == alone.columns
    assert sorted(map(str, found.collect())) == sorted(map(str, alone.collect()))
    assert sorted(map(str, current_rows(found, ["k"]).collect())) == sorted(map(str, current_rows(alone, ["k"]).collect()))
