"""Change records to current (type 1) and historical (type 2) tables, and deduplication."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from veriflux.functions.hashing import null_safe_hash
from veriflux.operators.ordered import OrderedRows, SkewPolicy


# Names what columns of merged winners share.
TOGETHER = "_together_"


def business(columns: Sequence[str]) -> list[str]:
    """Columns that describe the record; those that start with an underscore describe the run."""
    return [c for c in columns if not c.startswith("_")]


def _rank(keys: Sequence[str], sequence: Sequence[str], columns: Sequence[str], unique: bool) -> Column:
    """What orders the records of a key. Unless the sequence is unique per key, a hash of the business columns
    decides between equals, so that all of them come from the same record, whenever it was processed."""
    if not unique:
        return F.struct(*sequence, null_safe_hash(*keys, *business(columns)).alias("_tie"))
    return F.struct(*sequence) if len(sequence) > 1 else F.col(sequence[0])


def winners(
    changes: DataFrame, keys: Sequence[str], sequence: Sequence[str], columns: Sequence[str],
    ignore_nulls: bool = True, delete_when: Column | None = None, unique_sequence: bool = False, together: Sequence[Sequence[str]] = (),
) -> DataFrame:
    """Per key and column the struct (seq, value) with the highest sequence.

    max over structs is associative, so these partial states merge in any order: over map tasks, over
    micro-batches, and over late records. Columns that are `together` share a struct and its sequence, as far as
    records have values in all of them; `apart` undoes it.
    """
    deleted = F.lit(False) if delete_when is None else F.coalesce(delete_when, F.lit(False))
    rows = changes.withColumns({"_seq": _rank(keys, sequence, columns, unique_sequence), "_deleted": deleted})
    live = ~F.col("_deleted")
    whole = [reduce(Column.__and__, [F.col(c).isNotNull() if ignore_nulls else F.lit(True) for c in group]) for group in together]
    alone = {c: ~is_whole for group, is_whole in zip(together, whole, strict=True) for c in group}
    return rows.groupBy(*keys).agg(
        F.max(F.when(live, F.col("_seq"))).alias("_live"),
        F.max(F.when(~live, F.col("_seq"))).alias("_gone"),
        *[
            F.max(F.when(live & alone.get(c, F.lit(True)) & (F.col(c).isNotNull() if ignore_nulls else F.lit(True)),
                         F.struct(F.col("_seq").alias("seq"), F.col(c).alias("value")))).alias(c)
            for c in columns
        ],
        *[
            F.max(F.when(live & is_whole, F.struct(F.col("_seq").alias("seq"), F.struct(*group).alias("value")))).alias(f"{TOGETHER}{i}")
            for i, (group, is_whole) in enumerate(zip(together, whole, strict=True))
        ],
    )


def neighbours(columns: Sequence[str], unique_sequence: bool = False, size: int = 8) -> list[list[str]]:
    """Columns that `winners` may keep together. Records of equal rank have to agree in them: the hash that decides between
    equal sequences covers the business columns; where a sequence is only promised to be unique, there are none."""
    covered = [] if unique_sequence else business(columns)
    return [covered[i : i + size] for i in range(0, len(covered), size)]


def apart(state: DataFrame, together: Sequence[Sequence[str]]) -> DataFrame:
    """Merged winners with a struct for each column."""
    shared = {c: F.col(f"{TOGETHER}{i}") for i, group in enumerate(together) for c in group}
    return state.select(*[
        F.greatest(F.col(c), F.when(shared[c].isNotNull(), F.struct(shared[c]["seq"].alias("seq"), shared[c]["value"][c].alias("value")))).alias(c)
        if c in shared else F.col(c)
        for c in state.columns if not c.startswith(TOGETHER)
    ])


def merge_winners(partials: DataFrame, keys: Sequence[str]) -> DataFrame:
    return partials.groupBy(*keys).agg(*[F.max(c).alias(c) for c in partials.columns if c not in keys])


def current_rows(state: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Table rows from merged winners; what a later delete covers is gone."""
    columns = [c for c in state.columns if c not in {*keys, "_live", "_gone"}]
    survives = F.col("_live").isNotNull() & (F.col("_gone").isNull() | (F.col("_live") > F.col("_gone")))
    return state.filter(survives).select(
        *keys,
        *[
            F.when(F.col("_gone").isNull() | (F.col(c)["seq"] > F.col("_gone")), F.col(c)["value"]).alias(c)
            for c in columns
        ],
    )


def _payload(changes: DataFrame, keys: Sequence[str], exclude: Sequence[str]) -> list[str]:
    return [c for c in changes.columns if c not in {*keys, *exclude}]


def scd1(
    changes: DataFrame,
    keys: Sequence[str],
    sequence: Sequence[str],
    exclude: Sequence[str] = (),
    ignore_null_updates: bool = True,
    delete_when: Column | None = None,
    unique_sequence: bool = False,
) -> DataFrame:
    """Current row per key: for every column the latest value, nulls not overwriting by default.

    `unique_sequence` says that no two different records of a key share a sequence; it saves hashing every
    record, and with it reading columns that nobody selects.
    """
    columns = _payload(changes, keys, exclude)
    if delete_when is not None:
        state = winners(changes, keys, sequence, columns, ignore_null_updates, delete_when, unique_sequence)
        return current_rows(state, keys)
    rows = changes.withColumn("_seq", _rank(keys, sequence, columns, unique_sequence)).groupBy(*keys)
    if ignore_null_updates:
        return rows.agg(*[
            F.max_by(F.col(c), F.when(F.col(c).isNotNull(), F.col("_seq"))).alias(c) for c in columns
        ])
    return rows.agg(F.max_by(F.struct(*columns), "_seq").alias("_row")).select(*keys, "_row.*")


def change_rows(
    changes: DataFrame, keys: Sequence[str], delete_when: Column | None = None
) -> DataFrame:
    """Change records with what `versions` needs: a tie-break and a delete mark."""
    deleted = F.lit(False) if delete_when is None else F.coalesce(delete_when, F.lit(False))
    return changes.withColumns({
        "_tie": null_safe_hash(*business([c for c in changes.columns if c not in keys])),
        "_deleted": deleted,
    })


def versions(
    rows: DataFrame, keys: Sequence[str], order: Sequence[str], track: Sequence[str], policy: SkewPolicy, origin: Column | None = None
) -> DataFrame:
    """One row per run of equal `_deleted` and `track` values, in the total order of the `order` columns.

    It carries the columns of the last row of the run, the order values of its first row as `_from_*`, and
    the `_from_*` of the following run as `_next` (null for the last one). `origin` replaces the order
    values of a first row that stands for an older run.
    """
    columns = [c for c in rows.columns if c not in keys]
    # Copies of a record change nothing: the last of a run is the same with and without them.
    # Tracked columns are compared one by one: a struct of them would travel beside them through every shuffle.
    tracked = ["_deleted", *(c for c in track if c != "_deleted")]
    ordered = OrderedRows(rows, keys, order, policy, merge_copies=True).previous(tracked)
    # The first row of a key has no predecessor, so its previous delete mark is null and differs.
    starts_here = reduce(Column.__or__, [changed(F.col(c), F.col(f"prev_{c}")) for c in tracked])
    # A run keeps the slice of its first row, so that its rows need not meet the table of slices again.
    sliced = ordered.hot is not None and origin is None
    begin = F.struct(*order, *(["_slice"] if sliced else [])) if origin is None else origin
    ordered = ordered.with_column("_start", F.when(starts_here, begin)).running_last("_start", "_version")
    runs = (
        ordered.rows
        .groupBy(*keys, "_version")
        .agg(F.max_by(F.struct(*columns), F.struct(*order)).alias("_row"))
        .select(
            *keys, "_row.*", *[F.col("_version")[c].alias(f"_from_{c}") for c in order],
            *([F.col("_version")["_slice"].alias("_slice")] if sliced else []))
    )
    starts = [f"_from_{c}" for c in order]
    ends = OrderedRows(runs, keys, starts, policy, hot=ordered.hot, look_for_hot=False, sliced=sliced)
    return ends.following([starts[0]]).result().withColumnRenamed(f"next_{starts[0]}", "_next")


def scd2(
    changes: DataFrame,
    keys: Sequence[str],
    sequence: Sequence[str],
    track: Sequence[str],
    policy: SkewPolicy = SkewPolicy(),
    delete_when: Column | None = None,
) -> DataFrame:
    """History rows with `valid_from` and `valid_to` (null while current).

    A new version starts where a tracked column differs from the record before; other columns show
    their latest value within the version. A delete ends the version before it and starts none.
    """
    rows = change_rows(changes, keys, delete_when)
    return history_rows(versions(rows, keys, [*sequence, "_tie"], track, policy), changes.columns, sequence)


def history_rows(runs: DataFrame, columns: Sequence[str], sequence: Sequence[str]) -> DataFrame:
    return runs.filter(~F.col("_deleted")).select(
        *columns,
        F.col(f"_from_{sequence[0]}").alias("valid_from"),
        F.col("_next").alias("valid_to"),
    )


def current_versions(history: DataFrame) -> DataFrame:
    return history.filter(F.col("valid_to").isNull())


def changed(before: Column, after: Column) -> Column:
    """Null-safe change test for one column or a struct of columns."""
    return ~before.eqNullSafe(after)


def drop_duplicates(
    df: DataFrame, keys: Sequence[str], watermark: bool = False, first_by: Sequence[str] = ()
) -> DataFrame:
    """One row per key.

    `watermark` bounds the state of a stream; batch frames have no state and fall back to the plain
    form. `first_by` makes the surviving row of a batch frame the smallest in that order, ties going by the
    other columns. Copies are merged before the shuffle, so a much-repeated key stays cheap.
    """
    if watermark and df.isStreaming:
        return df.dropDuplicatesWithinWatermark(list(keys))
    if first_by and not df.isStreaming:
        others = [c for c in df.columns if c not in {*keys, *first_by}]
        first = df.groupBy(*keys).agg(F.min(F.struct(*first_by, *others)).alias("_row"))
        return first.select(*keys, "_row.*").select(*df.columns)
    return df.dropDuplicates(list(keys))
