"""Mixing sources to target weights by Pareto order sampling.

Each source gets a target in words. Its documents are due target / size copies each: the whole part is certain, the
fraction is an inclusion probability. For the fraction, documents are ranked by their random odds over their inclusion
odds and taken in this order as long as they fit into the words that are left; the last place goes to the remaining
document that comes nearest to the rest, if any comes nearer than none. Random numbers are hashes of the id, so that
reruns agree.

No source is sorted in one task: a histogram of ranks finds the bin where a source's sample ends, and only that bin is
ordered. Sources that are due a whole number of copies have no sample. What comes out of it, one row for each source, decides on every document by itself.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from veriflux.llm.store import stored

WEIGHTS = (5, 2, 1)
BINS = 1 << 12
BROADCAST_SOURCES = 100_000
WORD = r"[^\x20\x09-\x0D]+"


def _rows(docs: DataFrame, id_col: str, text_col: str, source_col: str, odds: Column, seed: str) -> DataFrame:
    """The row itself as `row`, and beside it key, content, source, size, u (uniform in (0, 1)) and odds."""
    text, own = docs[text_col].cast("string"), docs[id_col].cast("string")
    key = F.coalesce(own, F.concat(F.lit("#"), F.md5(F.coalesce(text, F.lit("")))))
    digits = F.conv(F.substring(F.md5(F.concat(F.lit(f"{seed}:"), key)), 1, 13), 16, 10).cast("long")
    return docs.select(
        F.struct(*(docs[c] for c in docs.columns)).alias("row"), key.alias("key"), F.xxhash64(text).alias("content"),
        docs[source_col].cast("string").alias("source"), F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long").alias("size"),
        ((digits + 0.5) / F.lit(float(1 << 52))).alias("u"), odds.cast("double").alias("odds"),
    )


def targets(sizes: DataFrame, weights: tuple[float, ...] = WEIGHTS, most: float = 3.0) -> DataFrame:
    """source, source_size, target from the summed sizes of each source; one row for each source is ordered.

    Sources by code point, null last, weigh `weights`, repeating, and share all words. Targets stop at `most` times the
    source's size: with sources ordered by limit over weight, those that stop are the first ones.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    weight = F.element_at(F.array(*(F.lit(float(w)) for w in weights)), (F.row_number().over(by_name) - 1) % len(weights) + 1)
    rows = sizes.select("source", "source_size", weight.alias("weight"), (F.col("source_size") * most).alias("cap"))
    order = Window.orderBy(F.col("cap") / F.col("weight"), F.col("source").asc_nulls_last())
    everything = Window.orderBy(F.lit(0)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    earlier = F.coalesce(F.sum("cap").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))
    later = F.sum("weight").over(order.rowsBetween(0, Window.unboundedFollowing))
    level = (F.sum("source_size").over(everything) - earlier) / later
    rows = rows.withColumns({"level": level, "place": F.row_number().over(order)})
    fits = F.when(F.col("level") * F.col("weight") <= F.col("cap"), F.struct("place", "level"))
    shared = F.min(fits).over(everything)["level"]
    return rows.select("source", "source_size", F.least(F.col("cap"), shared * F.col("weight")).alias("target"))


def _rank() -> Column:
    """Random odds over inclusion odds, q, as q / (1 + q): the same order, between 0 and 1."""
    chance = F.col("share") * F.col("odds") / (1 - F.col("share") + F.col("share") * F.col("odds"))
    high, low = F.col("u") * (1 - chance), chance * (1 - F.col("u"))
    return high / (high + low)


def _bin() -> Column:
    """Ranks turned back into u, where all odds are 1, so that a source spreads over its bins whatever its share is. Each step
    keeps the order of ranks also when rounded, and equal ranks share a bin."""
    within, above = F.col("rank") * F.col("share"), (1 - F.col("rank")) * (1 - F.col("share"))
    spread = F.when(within > 0, F.lit(float(BINS)) / (1 + above / F.nullif(within, F.lit(0.0)))).otherwise(0.0)
    return F.least(F.floor(spread), F.lit(BINS - 1)).cast("int")


def _same_source(left: DataFrame, right: DataFrame, sources: int, how: str = "inner") -> DataFrame:
    """Joins with a table of one row for each source, which may be null; it is sent to all tasks if it is small, so that
    documents stay where they are."""
    right = right.withColumnRenamed("source", "its_source")
    return left.join(F.broadcast(right) if sources <= BROADCAST_SOURCES else right, F.col("source").eqNullSafe(F.col("its_source")), how).drop("its_source")


def plan(rows: DataFrame, weights: tuple[float, ...], most: float) -> tuple[DataFrame, int]:
    """One row for each source: target, certain copies, where its sample ends (bin, last key) and the document that
    fills the rest; and the number of sources. rows: key, content, source, size, u, odds."""
    rows = stored(rows, "mix-sizes")
    sources = targets(rows.groupBy("source").agg(F.sum("size").alias("source_size")), weights, most)
    due = F.when(F.col("source_size") > 0, F.col("target") / F.nullif(F.col("source_size"), F.lit(0))).otherwise(0.0)
    whole = F.floor(due)
    sources = stored(sources.select(
        "source", "source_size", "target", whole.alias("copies"), (due - whole).alias("share"),
        (F.col("target") - whole * F.col("source_size")).alias("left"),
    ), "mix-targets")
    count = sources.count()
    ranked = _same_source(rows, sources, count).withColumn("rank", _rank()).withColumn("bin", _bin())
    bins = ranked.filter("share > 0").groupBy("source", "bin", "left").agg(F.sum("size").alias("words"))
    through = F.sum("words").over(Window.partitionBy("source").orderBy("bin"))
    bins = bins.select("source", "bin", "left", "words", through.alias("through")).filter(F.col("through") > F.col("left"))
    ends = bins.groupBy("source").agg(F.min(F.struct("bin", (F.col("through") - F.col("words")).alias("before"))).alias("end"))
    ends = stored(_same_source(sources, ends.select("source", "end.bin", "end.before").withColumnRenamed("bin", "end_bin"), count, "left"), "mix-ends")
    ranked = _same_source(rows, ends, count).withColumn("rank", _rank()).withColumn("bin", _bin())
    place = F.struct("rank", "key", "content")
    inside = ranked.filter(F.col("bin") == F.col("end_bin"))
    running = F.col("before") + F.sum("size").over(Window.partitionBy("source").orderBy("rank", "key", "content"))
    inside = inside.select("source", place.alias("place"), running.alias("running"), "left").filter(F.col("running") <= F.col("left"))
    lasts = inside.groupBy("source").agg(F.max(F.struct("place", "running")).alias("last"))
    lasts = _same_source(ends, lasts.select("source", F.col("last.place").alias("last_place"), F.col("last.running").alias("taken_words")), count, "left")
    lasts = stored(lasts.withColumn("gap", F.col("left") - F.coalesce("taken_words", "before")), "mix-lasts")
    ranked = _same_source(rows, lasts, count).withColumn("rank", _rank()).withColumn("bin", _bin())
    off = F.abs(F.col("size") - F.col("gap"))
    rest = ranked.filter(~_sampled(place)).filter(off < F.col("gap"))
    fill = rest.groupBy("source").agg(F.min(F.struct(off.alias("off"), place.alias("place")))["place"].alias("fill"))
    return _same_source(lasts, fill, count, "left").drop("before", "taken_words", "gap", "left"), count


def _sampled(place: Column) -> Column:
    ends_here = (F.col("bin") == F.col("end_bin")) & F.coalesce(place <= F.col("last_place"), F.lit(False))
    return F.col("end_bin").isNull() & (F.col("share") > 0) | F.coalesce((F.col("bin") < F.col("end_bin")) | ends_here, F.lit(False))


def mix(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
    weights: tuple[float, ...] = WEIGHTS, most: float = 3.0, odds: Column | None = None, seed: str = "mix",
) -> DataFrame:
    """row (the document), size, source_size, target and copies (how often the mix takes it, 0 to `most`).

    `odds` multiplies the inclusion odds of a document (1 by default). Null and empty texts have size 0 and are taken as
    often as their rank says, which adds no words. A null source is a source of its own and comes last. A source
    without words has target 0 and none of its documents is sampled. Rows without an id are told apart by their text;
    full copies of a row share their fate, so a sample may miss its words by their size. An empty table gives no rows.
    `docs` is read twice and never shuffled: sizes are written once, and the plan, one row for each source, is joined.
    """
    odds = F.lit(1.0) if odds is None else odds
    rows = _rows(docs, id_col, text_col, source_col, odds, seed)
    decided, count = plan(rows.drop("row"), weights, most)
    ranked = _same_source(rows, decided, count).withColumn("rank", _rank()).withColumn("bin", _bin())
    place = F.struct("rank", "key", "content")
    taken = _sampled(place) | F.coalesce(place == F.col("fill"), F.lit(False))
    return ranked.select("row", "size", "source_size", "target", (F.col("copies") + taken.cast("long")).cast("int").alias("copies"))


def repeated(mixed: DataFrame) -> DataFrame:
    """The documents of a mix, each as often as the mix takes it, with their own columns."""
    taken = mixed.filter("copies > 0").select("row", F.explode(F.sequence(F.lit(1), F.col("copies"))).alias("copy"))
    return taken.select("row.*")
