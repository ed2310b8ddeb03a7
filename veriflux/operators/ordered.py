"""Row order inside a key, without handing a hot key to one task.

A window partitioned by customer puts every row of that customer into one task. Keys above a row
threshold are therefore cut into consecutive slices of their order columns, windows run per slice, and
what a slice needs from its predecessors is carried over from a summary with one row per slice.
Keys below the threshold form a single slice; when no key is hot the plan is the ordinary window.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F
from pyspark.sql.types import (
    DataType, DateType, NumericType, StringType, TimestampNTZType, TimestampType,
)

from veriflux.operators.sizing import MAX_BROADCAST_ROWS, fits_broadcast
from veriflux.session import shared_dir

SAMPLED_ROWS = 1000
MAX_LEVELS = 6
# Below the first level a slice is cut at no more than this many points.
MAX_POINTS = 63
# Slice numbers of a level follow those of the level above with this factor between.
STRIDE = 256


@dataclass(frozen=True)
class SkewPolicy:
    # A key with more rows than this is sliced, each slice holding about this many rows. None skips the
    # count and promises that no key is hot.
    hot_rows: int | None = 2_000_000
    # Largest table of hot keys or slices that is broadcast; a larger one is joined by shuffle.
    max_broadcast_rows: int = MAX_BROADCAST_ROWS


def _names(columns: str | Sequence[str]) -> list[str]:
    return [columns] if isinstance(columns, str) else list(columns)


def _same(keys: Sequence[tuple[str, str]]) -> Column:
    return reduce(Column.__and__, [F.col(a).eqNullSafe(F.col(b)) for a, b in keys])


def _common_bytes(low: Column, high: Column) -> Column:
    """Number of leading bytes that two strings share."""
    a, b = F.hex(low.cast("binary")), F.hex(high.cast("binary"))
    shorter = F.floor(F.least(F.length(a), F.length(b)) / 2).cast("int")
    same = F.filter(F.sequence(F.lit(0), shorter),
                    lambda n: F.substring(a, F.lit(1), n * 2) == F.substring(b, F.lit(1), n * 2))
    return F.size(same) - 1


def _number(value: Column, kind: DataType, skip: Column) -> Column | None:
    """A double that never falls as `value` rises; for strings from the six bytes after the first `skip`,
    which have to be the same in all of them."""
    if isinstance(kind, (TimestampType, TimestampNTZType)):
        return F.unix_micros(value.cast("timestamp")).cast("double")
    if isinstance(kind, DateType):
        return F.unix_date(value).cast("double")
    if isinstance(kind, NumericType):
        return value.cast("double")
    if kind == StringType():
        following = F.hex(F.substring(value.cast("binary"), skip + 1, F.lit(6)))
        return F.conv(F.rpad(following, 12, "0"), 16, 10).cast("double")
    return None


def _chosen_number(values: Sequence[Column], kinds: Sequence[DataType]) -> Column:
    """The number of the column that `_by` names."""
    numbers = [_number(v, kind, F.col("_skip")) for v, kind in zip(values, kinds)]
    return F.coalesce(*[F.when(F.col("_by") == i, n) for i, n in enumerate(numbers) if n is not None], F.lit(0.0))


@dataclass(frozen=True)
class Cuts:
    """Groups that are too large and how order column number `_by` cuts each of them; the columns before it
    are constant in the group.

    Even cuts make `_parts` pieces of equal width between `_lo` and `_hi`. The others cut at `_points`, each
    point being a piece of its own, which isolates values that have many rows.
    """

    table: DataFrame
    even: bool
    broadcast: bool
    pieces: int

    def _inner(self, at: Column) -> Column:
        """The piece by the number of a value between the bounds."""
        if self.even:
            parts, start, end = F.col("_parts"), F.col("_start"), F.col("_end")
            share = (at - start) / F.nullif(end - start, F.lit(0.0))
            return F.coalesce(F.least(parts - 1, F.floor(share * parts)), F.lit(0))
        below = F.size(F.filter("_points", lambda point: point < at))
        return 2 * below + F.array_contains("_points", at).cast("int")

    def _piece(self, order: Sequence[str]) -> Column:
        """Zero for nulls, which sort first. Rows may lie beyond the bounds, which come from a sample."""
        number = F.lit(0)
        for i in reversed(range(len(order))):
            value, low, high = F.col(order[i]), F.col("_lo")[f"o{i}"], F.col("_hi")[f"o{i}"]
            here = F.col("_by") == i
            inside = F.when(here, value.between(low, high)).otherwise(value.eqNullSafe(low))
            number = (
                F.when(inside, F.when(here, F.col("_inner") + 1).otherwise(number))
                .when(value.isNull(), 0)
                .when(value < low, 1)
                .otherwise(F.col("_parts"))
            )
        return F.when(F.col("_parts").isNotNull(), number.cast("bigint"))

    def add_piece(
        self, df: DataFrame, groups: Sequence[str], order: Sequence[str], kinds: Sequence[DataType]
    ) -> DataFrame:
        """Adds `_piece`, never falling in the order; null for rows outside the groups."""
        side = F.broadcast(self.table) if self.broadcast else self.table
        df = df.join(side, _same([(g, f"_hot_{g}") for g in groups]), "left")
        df = df.withColumn("_inner", self._inner(_chosen_number([F.col(c) for c in order], kinds)))
        return df.withColumn("_piece", self._piece(order)).drop("_inner", *self.table.columns)


@dataclass(frozen=True)
class HotKeys:
    """The keys above the threshold, cut level by level: a slice that turns out too large, because its rows
    are crowded or tied, is cut again by its own bounds or by the next order column."""

    kinds: tuple[DataType, ...]
    levels: tuple[Cuts, ...]
    # Whether rows without an order among them may fill a task.
    tied: bool = False

    @classmethod
    def find(
        cls, df: DataFrame, keys: Sequence[str], order: str | Sequence[str], policy: SkewPolicy
    ) -> HotKeys | None:
        """Counts the rows per key on a column-pruned sample; None when no key is above the threshold.

        The sample only decides which keys are sliced and where. Every row gets exactly one slice, in
        order, whatever the answer, so results do not depend on it; but all branches of a plan have to see
        the same answer, which is why it is stored.
        """
        if policy.hot_rows is None:
            return None
        order = _names(order)
        # A key at the threshold is expected SAMPLED_ROWS times in the sample.
        fraction = min(1.0, SAMPLED_ROWS / policy.hot_rows)
        limit = policy.hot_rows * fraction

        def sampled(columns: Sequence[str]) -> DataFrame:
            rows = df.select(*columns)
            return rows.sample(fraction, seed=0) if fraction < 1 else rows

        sizes = sampled(keys).groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
        hot = sizes.filter(F.col("_n") > limit).select(*[F.col(k).alias(f"_hot_{k}") for k in keys])
        hot = hot.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            if not hot.count():
                return None
            path = shared_dir(df.sparkSession, "hot-keys")
            side = F.broadcast(hot) if fits_broadcast(hot, policy.max_broadcast_rows) else hot
            pairs = [(k, f"_hot_{k}") for k in keys]
            rows = sampled(list(dict.fromkeys([*keys, *order]))).join(side, _same(pairs), "left_semi")
            rows.write.parquet(f"{path}/sample")
        finally:
            hot.unpersist()
        rows = df.sparkSession.read.schema(rows.schema).parquet(f"{path}/sample")
        found = cls(tuple(df.schema[c].dataType for c in order), ())
        while len(found.levels) < MAX_LEVELS:
            cuts = found._next_cuts(rows, keys, order, limit, policy, f"{path}/level-{len(found.levels)}")
            if cuts is None:
                break
            found = cls(found.kinds, (*found.levels, cuts))
        if not found.levels:
            return None
        most = rows.groupBy(*dict.fromkeys([*keys, *order])).count().agg(F.max("count")).first()[0]
        return cls(found.kinds, found.levels, bool(most and most > max(1, limit / 4)))

    def _next_cuts(
        self, sample: DataFrame, keys: Sequence[str], order: Sequence[str], limit: float, policy: SkewPolicy, path: str
    ) -> Cuts | None:
        first = not self.levels
        groups = list(keys) if first else [*keys, "_slice"]
        low, high = (
            F.struct(*[pick(c).alias(f"o{i}") for i, c in enumerate(order)]) for pick in (F.min, F.max)
        )
        sliced = self.slice(sample, keys, order)
        sizes = sliced.groupBy(*groups).agg(
            F.count(F.lit(1)).alias("_n"), low.alias("_lo"), high.alias("_hi")
        )
        # The first column that varies; a column without numbers cannot be cut.
        by = F.coalesce(
            *[
                F.when(F.col("_lo")[f"o{i}"] < F.col("_hi")[f"o{i}"],
                       F.lit(-1 if _number(F.col(c), self.kinds[i], F.lit(0)) is None else i))
                for i, c in enumerate(order)
            ],
            F.lit(-1),
        )
        skips = [
            F.when(F.col("_by") == i, _common_bytes(F.col("_lo")[f"o{i}"], F.col("_hi")[f"o{i}"]))
            for i, kind in enumerate(self.kinds) if kind == StringType()
        ]
        sizes = sizes.withColumn("_by", by)
        if not first:
            sizes = sizes.filter((F.col("_n") > 2 * limit) & (F.col("_by") >= 0))
        # At the first level every hot key is listed, also if all its rows are tied.
        parts = F.when(F.col("_by") >= 0, F.ceil(F.col("_n") / F.lit(limit))).otherwise(1)
        dense = sizes.select(
            *[F.col(g).alias(f"_hot_{g}") for g in groups], "_lo", "_hi",
            F.greatest("_by", F.lit(0)).alias("_by"), parts.alias("_parts"),
            F.coalesce(*skips, F.lit(0)).cast("int").alias("_skip"),
        )
        ends = [
            _chosen_number([F.col(bound)[f"o{i}"] for i in range(len(order))], self.kinds) for bound in ("_lo", "_hi")
        ]
        dense.withColumns({"_start": ends[0], "_end": ends[1]}).write.parquet(f"{path}/groups")
        table = sample.sparkSession.read.parquet(f"{path}/groups")
        if table.isEmpty():
            return None
        if not first:
            self._with_points(table, sliced, groups, order, policy).write.parquet(f"{path}/points")
            table = sample.sparkSession.read.parquet(f"{path}/points")
        pieces = table.agg(F.sum(F.col("_parts") + 1)).first()[0]
        return Cuts(table, first, fits_broadcast(table, policy.max_broadcast_rows), pieces)

    def _with_points(
        self, table: DataFrame, sliced: DataFrame, groups: Sequence[str], order: Sequence[str], policy: SkewPolicy
    ) -> DataFrame:
        """Adds evenly spaced quantiles of the column that is cut, and the number of pieces they make."""
        side = F.broadcast(table) if fits_broadcast(table, policy.max_broadcast_rows) else table
        names = [f"_hot_{g}" for g in groups]
        at = _chosen_number([F.col(c) for c in order], self.kinds)
        shares = [(i + 1) / (MAX_POINTS + 1) for i in range(MAX_POINTS)]
        quantiles = (
            sliced.join(side, _same(list(zip(groups, names))))
            .groupBy(*names)
            .agg(F.percentile_approx(at, shares, 4096).alias("_all"))
            .withColumnsRenamed({name: f"_q{name}" for name in names})
        )
        parts = F.least(F.col("_parts"), F.lit(MAX_POINTS + 1))
        points = F.transform(
            F.sequence(F.lit(1), parts.cast("int") - 1),
            lambda j: F.get("_all", F.round(j * (MAX_POINTS + 1) / parts).cast("int") - 1),
        )
        return (
            table.join(quantiles, _same([(name, f"_q{name}") for name in names]))
            .withColumn("_points", F.array_sort(F.array_distinct(points)))
            .withColumn("_parts", (2 * F.size("_points") + 1).cast("bigint"))
            .select(*table.columns, "_points")
        )

    def slice(self, df: DataFrame, keys: Sequence[str], order: str | Sequence[str]) -> DataFrame:
        """Adds `_slice`, non-decreasing in `order`; null for keys that are not hot."""
        order = _names(order)
        for level, cuts in enumerate(self.levels):
            df = cuts.add_piece(df, [*keys, "_slice"] if level else keys, order, self.kinds)
            inner = F.coalesce("_piece", F.lit(0))
            df = df.withColumn("_slice", F.col("_slice") * STRIDE + inner if level else F.col("_piece")).drop("_piece")
        return df

    @property
    def table(self) -> DataFrame:
        """One row per hot key."""
        return self.levels[0].table

    @property
    def slices(self) -> int:
        """No more slices than this exist."""
        return sum(cuts.pieces for cuts in self.levels)


class OrderedRows:
    """Rows grouped by `keys` in the total order of the `order` columns.

    With `merge_copies` rows of a hot key that agree in every column become one row, so that a much-repeated
    row, which no order can cut, does not end up in one task. For uses whose result is the same without copies; where the
    sample shows no such row, copies stay and a shuffle of all rows is saved.
    """

    def __init__(
        self,
        df: DataFrame,
        keys: Sequence[str],
        order: Sequence[str],
        policy: SkewPolicy = SkewPolicy(),
        hot: HotKeys | None = None,
        look_for_hot: bool = True,
        merge_copies: bool = False,
        sliced: bool = False,
    ):
        self.keys, self.order, self.policy = list(keys), list(order), policy
        self.hot = HotKeys.find(df, keys, order, policy) if look_for_hot else hot
        # `sliced` says that the rows have the slices of `hot` already.
        self.rows = self.hot.slice(df, keys, order) if self.hot and not sliced else df
        if self.hot and self.hot.tied and merge_copies:
            sliced = self.rows.filter(F.col("_slice").isNotNull()).distinct()
            self.rows = self.rows.filter(F.col("_slice").isNull()).unionByName(sliced)

    def _window(self, backwards: bool = False) -> WindowSpec:
        parts = [*self.keys, "_slice"] if self.hot else self.keys
        order = [F.col(c).desc() if backwards else F.col(c).asc() for c in self.order]
        return Window.partitionBy(*parts).orderBy(*order)

    def _neighbour(self, columns: Sequence[str], prefix: str, following: bool) -> OrderedRows:
        rows = self.rows
        if self.hot:
            # The row nearest to the next slice joins that slice as a carried row.
            pick = F.min_by if following else F.max_by
            edge_columns = [c for c in dict.fromkeys([*self.order, *columns])]
            step = F.lag if following else F.lead
            edges = (
                rows.filter(F.col("_slice").isNotNull())
                .groupBy(*self.keys, "_slice")
                .agg(pick(F.struct(*edge_columns), F.struct(*self.order)).alias("_edge"))
                .withColumn("_slice", step("_slice").over(Window.partitionBy(*self.keys).orderBy("_slice")))
                .filter(F.col("_slice").isNotNull())
                .select(*self.keys, "_slice", "_edge.*", F.lit(True).alias("_carried"))
            )
            rows = rows.withColumn("_carried", F.lit(False)).unionByName(edges, allowMissingColumns=True)
        window = self._window(backwards=following)
        rows = rows.withColumns({f"{prefix}{c}": F.lag(c).over(window) for c in columns})
        if self.hot:
            rows = rows.filter(~F.col("_carried")).drop("_carried")
        return self._with(rows)

    def _with(self, rows: DataFrame) -> OrderedRows:
        other = object.__new__(OrderedRows)
        other.__dict__.update(self.__dict__, rows=rows)
        return other

    def with_column(self, name: str, value: Column) -> OrderedRows:
        return self._with(self.rows.withColumn(name, value))

    def previous(self, columns: Sequence[str], prefix: str = "prev_") -> OrderedRows:
        """Adds the values of the preceding row of the same key."""
        return self._neighbour(columns, prefix, following=False)

    def following(self, columns: Sequence[str], prefix: str = "next_") -> OrderedRows:
        """Adds the values of the succeeding row of the same key."""
        return self._neighbour(columns, prefix, following=True)

    def running_last(self, column: str, name: str) -> OrderedRows:
        """Adds the latest non-null value of `column` up to and including the row."""
        window = self._window().rowsBetween(Window.unboundedPreceding, Window.currentRow)
        rows = self.rows.withColumn(name, F.last(column, ignorenulls=True).over(window))
        if self.hot:
            known = F.col(column).isNotNull()
            per_slice = (
                self.rows.filter(F.col("_slice").isNotNull())
                .groupBy(*self.keys, "_slice")
                .agg(F.max_by(F.when(known, F.col(column)), F.when(known, F.struct(*self.order))).alias("_latest"))
            )
            earlier = Window.partitionBy(*self.keys).orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
            carried = per_slice.select(
                *[F.col(k).alias(f"_c_{k}") for k in [*self.keys, "_slice"]],
                F.last("_latest", ignorenulls=True).over(earlier).alias("_before"),
            )
            side = F.broadcast(carried) if self.hot.slices <= self.policy.max_broadcast_rows else carried
            pairs = [(k, f"_c_{k}") for k in [*self.keys, "_slice"]]
            rows = (
                rows.join(side, _same(pairs), "left")
                .withColumn(name, F.coalesce(name, "_before"))
                .drop("_before", *[b for _, b in pairs])
            )
        return self._with(rows)

    def result(self) -> DataFrame:
        return self.rows.drop("_slice")
