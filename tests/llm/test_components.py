"""Components around hubs, and lookups of keys with many rows."""

import random

import pytest
from pyspark.sql import functions as F

from veriflux.llm import components as C
from veriflux.llm import near_copies

KEY = "struct<nul:boolean,id:bigint,node:bigint>"


@pytest.fixture
def low_bounds(monkeypatch):
    monkeypatch.setattr(C, "HUB_ROWS", 3)
    monkeypatch.setattr(C, "HUBS", 40)


def plain_roots(links):
    up = {x: x for link in links for x in link}

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    for a, b in links:
        a, b = root(a), root(b)
        up[max(a, b)] = min(a, b)
    return {x: root(x) for x in up}


def test_stars_paths_and_loops(spark, low_bounds):
    rng = random.Random(5)
    links = [(70, k) for k in range(100, 130)] + [(k, k + 1) for k in range(200, 240)] + [(5, 5), (70, 200)]
    links += [(rng.randrange(300, 400), rng.randrange(300, 400)) for _ in range(60)] + [(8, 9), (9, 8)]
    links = [((a % 7 == 0, a, -a), (b % 7 == 0, b, -b)) for a, b in links]
    got = C.components(spark.createDataFrame(links, f"a {KEY}, b {KEY}")).collect()
    want = plain_roots([link for link in links if link[0] != link[1]])
    assert {tuple(r.node): tuple(r.root) for r in got} == want and len(got) == len(want)
    assert C.components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_hubs_are_not_shuffled(spark, low_bounds):
    rows = spark.createDataFrame([(k if k < 5 else 7, k) for k in range(50)] + [(None, 50)], "key long, x long")
    table = rows.filter("key > 0").groupBy("key").agg(F.max("x").alias("most"), F.count("*").alias("times"))
    got = C.look_up(rows, table, ["key"], 51)
    assert sorted(map(str, map(tuple, got.collect()))) == sorted(map(str, map(tuple, rows.join(table.drop("times"), "key", "left").collect())))
    plan = got._jdf.queryExecution().toString()
    assert "BroadcastHashJoin" in plan


def test_copies_beyond_the_bounds(spark, low_bounds):
    """Large groups of exact and near copies take the broadcast way; null ids come last, repeated rows count as one."""
    base = [f"w{k}" for k in range(60)]
    near = [(100 + k, " ".join(base[:50] + [f"z{k}"])) for k in range(20)]
    rows = [(k, " ".join(base)) for k in range(10, 40)] + near + [(None, " ".join(base))] * 3 + [(3, "a b c d e f"), (3, "a b c d e f"), (4, None), (2, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r.component_id for r in near_copies.link_near_copies(docs).collect()}
    assert got == {**{k: 10 for k in range(10, 40)}, **{100 + k: 10 for k in range(20)}, None: 10, 3: 3, 4: 4, 2: 2}
    assert sorted(r.doc_id for r in near_copies.keep_one(docs).collect()) == [2, 3, 4, 10]
