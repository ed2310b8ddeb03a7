"""Connected components of a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from veriflux.llm.store import stored


HUB_ROWS = 4096  # keys with more rows than this are looked up without a shuffle of their rows,
HUBS = 50_000  # as far as there are no more of them


def look_up(rows: DataFrame, table: DataFrame, on: list[str], total: int) -> DataFrame:
    """Left join of `rows` with `table`, which holds one row for each key and, as `times`, how many of the `total` rows have it.

    Keys with many rows are broadcast: each has over total / HUBS rows, so there are less than HUBS. The rows of all other
    keys are shuffled, and no key brings more than max(HUB_ROWS, total / HUBS) rows to a task. `times` is dropped. `rows` is
    read twice and should be a stored table.
    """
    many = F.col("times") > max(HUB_ROWS, total // HUBS)
    hubs = F.broadcast(table.filter(many).drop("times"))
    others = rows.join(hubs.select(*on), on, "left_anti").join(table.filter(~many).drop("times"), on, "left")
    return rows.join(hubs, on).unionByName(others)


def _to_least(pairs: DataFrame, total: int, only_larger: bool) -> DataFrame:
    """Links the neighbours b of each a with the least node among a and its neighbours."""
    least = pairs.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"), F.count("*").alias("times"))
    joined = look_up(pairs, least, ["a"], total)
    if only_larger:
        out = joined.filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    else:
        out = joined.select(F.col("b").alias("a"), F.col("m").alias("b")).union(least.select("a", F.col("m").alias("b")))
    return out.filter("a <> b").distinct()


def components(links: DataFrame) -> DataFrame:
    """node, root (the least node of its component) for every node of `links` (a, b: of one type that has an order).

    Alternates two steps that hang nodes below ever smaller ones, until nothing changes; the number of rounds grows with
    the logarithm of the longest path. Nodes are grouped with partial aggregates and looked up by `look_up`, so that a
    node with very many links needs no task of its own. Every step is written below spark.checkpoint.dir.
    """
    pairs = stored(links.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "links")
    before = None
    while True:
        both = pairs.union(pairs.select(F.col("b").alias("a"), F.col("a").alias("b")))
        large = _to_least(both, 2 * pairs.count(), True)
        down = stored(large.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "links")
        pairs = stored(_to_least(down, down.count(), False), "links")
        now = pairs.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == before:
            break
        before = now
    return pairs.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("root")).union(pairs.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
