"""Joins against sides whose size has been looked at."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, MapType, StringType, StructType, VariantType

MAX_BROADCAST_ROWS = 200_000
MAX_BROADCAST_BYTES = 256 << 20


def _bytes(df: DataFrame) -> Column:
    """About how much memory a row takes."""
    width = F.lit(0)
    for field in df.schema.fields:
        kind = field.dataType
        if isinstance(kind, (ArrayType, MapType, StructType, VariantType)):
            size = F.octet_length(F.to_json(F.struct(field.name)))
        elif isinstance(kind, (StringType, BinaryType)):
            size = F.octet_length(field.name)
        else:
            size = F.lit(0)
        width = width + 16 + F.coalesce(size, F.lit(0))
    return width.cast("bigint")


def fits_broadcast(
    df: DataFrame, max_rows: int = MAX_BROADCAST_ROWS, max_bytes: int = MAX_BROADCAST_BYTES
) -> bool:
    """Measures `df`: one pre-aggregated row per task, no rows moved."""
    rows, size = df.agg(F.count(F.lit(1)), F.coalesce(F.sum(_bytes(df)), F.lit(0))).first()
    return rows <= max_rows and size <= max_bytes


def match(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str) -> DataFrame:
    """Null-safe join on equally named keys, kept once; `right` is broadcast when it is small."""
    renamed = right.withColumnsRenamed({k: f"_right_{k}" for k in keys})
    same = reduce(Column.__and__, [F.col(k).eqNullSafe(F.col(f"_right_{k}")) for k in keys])
    side = F.broadcast(renamed) if fits_broadcast(renamed) else renamed
    return left.join(side, same, how).drop(*[f"_right_{k}" for k in keys])


def hot_keys(df: DataFrame, keys: Sequence[str], rows_per_task: int, most: int = 1000) -> dict[int, int]:
    """Hashes of the keys that hold more than `rows_per_task` rows, and how many tasks their rows are due.

    One pass with a frequent-items sketch per task; at most `most` hashes with their estimated counts reach the
    driver. Estimates decide how rows are spread, never what is joined.
    """
    tracked = 8 * most
    found = df.select(F.xxhash64(*keys).alias("_h")).agg(F.expr(f"approx_top_k(_h, {most}, {tracked})")).first()[0]
    return {r["item"]: -(-r["count"] // rows_per_task) for r in found or [] if r["count"] > rows_per_task and r["item"] is not None}


def _salted(rows: DataFrame, keys: Sequence[str], salts: DataFrame) -> DataFrame:
    """Adds `_salts`, one for keys that are not hot. `salts` is small: a row per hot key."""
    hashed = rows.withColumn("_h", F.xxhash64(*keys))
    return hashed.join(F.broadcast(salts), "_h", "left").withColumn("_salts", F.coalesce("_salts", F.lit(1))).drop("_h")


def lookup_left(
    facts: DataFrame,
    dimension: DataFrame,
    on: Sequence[tuple[str, str]],
    spread_by: str,
    max_rows: int = MAX_BROADCAST_ROWS,
    salts: int = 64,
    rows_per_task: int = 2_000_000,
) -> DataFrame:
    """Left join of a large, possibly skewed fact side with a dimension unique on its keys.

    A dimension of checked size is broadcast and the facts stay where they are. With a larger one, the facts of a
    key that holds more than `rows_per_task` rows are spread by a hash of `spread_by` over as many tasks as they are due,
    and only the dimension rows of such keys are copied; all other keys take part in a plain shuffle join. A stream cannot
    be looked at beforehand: every dimension row is copied once per salt there. The dimension keys are dropped from the result.
    """
    keys = [right for _, right in on]
    if fits_broadcast(dimension, max_rows):
        condition = [facts[left] == dimension[right] for left, right in on]
        return facts.join(F.broadcast(dimension), condition, "left").drop(*[dimension[k] for k in keys])
    own = [left for left, _ in on]
    if facts.isStreaming:
        salted = facts.withColumn("_salts", F.lit(salts))
        copies = dimension.withColumn("_salts", F.lit(salts))
    else:
        # Keys are compared by value, so their hashes must be taken of one type.
        kinds = [facts.schema[c].dataType for c in own]
        alike = dimension.withColumns({f"_k{i}": F.col(k).cast(t) for i, (k, t) in enumerate(zip(keys, kinds, strict=True))})
        hot = hot_keys(facts, own, rows_per_task)
        table = facts.sparkSession.createDataFrame(list(hot.items()), "_h bigint, _salts int")
        salted = _salted(facts, own, table)
        copies = _salted(alike, [f"_k{i}" for i in range(len(keys))], table).drop(*[f"_k{i}" for i in range(len(keys))])
    salted = salted.withColumn("_salt", F.pmod(F.xxhash64(spread_by), F.col("_salts")).cast("int")).drop("_salts")
    copies = copies.withColumn("_copy", F.explode(F.sequence(F.lit(0), F.col("_salts") - 1))).drop("_salts")
    condition = [salted[left] == copies[right] for left, right in on] + [salted["_salt"] == copies["_copy"]]
    return (
        salted.join(copies, condition, "left")
        .drop(*[copies[k] for k in keys])
        .drop("_salt", "_copy")
    )
