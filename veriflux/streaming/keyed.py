"""What keyed streams keep for each key, and what they settle when the watermark passes it.

Both processors get the rows of a key in any order. They sort what they kept and what came, settle what lies before
the watermark and keep the rest. Columns are of simple types. Times are microseconds: Spark turns them back outside, so that no time zone of a
worker gets between.
"""

from __future__ import annotations

import math
import sys
from collections.abc import Iterable, Iterator, Sequence
from operator import itemgetter
from typing import Any

from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.types import DateType, StringType, StructField, StructType, TimestampNTZType, TimestampType

# The process that Spark starts on the driver to plan a processor sees neither added files nor this process's path, so
# processors travel whole.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

NEVER = -(1 << 62)
KIND = StructField("kind", StringType())


def as_micros(df: DataFrame) -> DataFrame:
    """Times as microseconds since 1970, dates as days."""

    def plain(f: StructField) -> Column:
        if isinstance(f.dataType, (TimestampType, TimestampNTZType)):
            return F.unix_micros(F.col(f.name).cast("timestamp")).alias(f.name)
        return F.unix_date(f.name).alias(f.name) if isinstance(f.dataType, DateType) else F.col(f.name)

    return df.select(*map(plain, df.schema.fields))


def as_times(df: DataFrame, given: StructType, prefixes: Sequence[str] = ("",)) -> DataFrame:
    """Columns named as in `given`, also behind a prefix, in the types of `given`."""
    kinds = {f"{p}{f.name}": f.dataType for f in given.fields for p in prefixes}

    def typed(name: str) -> Column:
        kind = kinds.get(name)
        if isinstance(kind, (TimestampType, TimestampNTZType)):
            return F.timestamp_micros(name).cast(kind).alias(name)
        return F.date_from_unix_date(name).alias(name) if isinstance(kind, DateType) else F.col(name)

    return df.select(*map(typed, df.columns))


def ordered_by(values: Sequence[Any]) -> tuple:
    """Sorts as Spark does: nulls first, NaN last."""
    return tuple((0, 0) if v is None else (2, 0) if isinstance(v, float) and math.isnan(v) else (1, v) for v in values)


def same(a: Any, b: Any) -> bool:
    return a == b or (isinstance(a, float) and isinstance(b, float) and math.isnan(a) and math.isnan(b))


class _Settling(StatefulProcessor):
    """Keeps one list of rows for a key. Subclasses say what follows from it at a watermark."""

    def __init__(self, kept: StructType, time_column: str, watermark: bool = True) -> None:
        self.kept, self.time, self.watermark = kept, kept.names.index(time_column), watermark

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.rows = handle.getListState("rows", self.kept)
        self.row = Row(*self.output().names)
        self.take: itemgetter | None = None

    def close(self) -> None:
        pass

    def _mark(self, timers: Any) -> int:
        """The watermark; before the first one, and in a stream without, nothing is settled or late."""
        return (timers.getCurrentWatermarkInMs() * 1000 or NEVER) if self.watermark else NEVER

    def handleInputRows(self, key: Any, rows: Iterator[Row], timerValues: Any) -> Iterator[Row]:
        mark = self._mark(timerValues)
        fresh = []
        for given in rows:
            if self.take is None:
                self.take = itemgetter(*map(given.__fields__.index, self.kept.names))
            row = self.take(given)
            if self.is_late(row, mark):
                yield self.late(row)
            else:
                fresh.append(row)
        if fresh:
            yield from self._advance([tuple(r) for r in self.rows.get()], fresh, mark)

    def handleExpiredTimer(self, key: Any, timerValues: Any, expiredTimerInfo: Any) -> Iterator[Row]:
        mark = self._mark(timerValues)
        yield from self._advance([tuple(r) for r in self.rows.get()], [], mark)

    def _advance(self, kept: list[tuple], fresh: list[tuple], mark: int) -> Iterator[Row]:
        due = self.due(kept) if self.watermark else None
        settled, rest = self.settle(kept + fresh, mark)
        yield from settled
        if fresh or len(rest) != len(kept):
            self.rows.put(rest) if rest else self.rows.clear()
        later = self.due(rest) if self.watermark else None
        if later is not None and (due is None or later < due or due < mark):
            self.handle.registerTimer(later // 1000 + 1)

    def is_late(self, row: tuple, mark: int) -> bool:
        return mark != NEVER and (row[self.time] is None or row[self.time] < mark)

    def output(self) -> StructType:
        raise NotImplementedError

    def late(self, row: tuple) -> Row:
        raise NotImplementedError

    def settle(self, rows: list[tuple], mark: int) -> tuple[Iterable[Row], list[tuple]]:
        """What is settled at the watermark, and the rows that are still needed."""
        raise NotImplementedError

    def due(self, rows: list[tuple]) -> int | None:
        """When the first of the kept rows can be settled."""
        raise NotImplementedError


class Lateness(StatefulProcessor):
    """Each row with whether its time lies behind the watermark. Keeps nothing."""

    def __init__(self, columns: StructType, time_column: str) -> None:
        self.names, self.time = columns.names, columns.names.index(time_column)

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.row = Row(*self.names, "_late")

    def close(self) -> None:
        pass

    def handleInputRows(self, key: Any, rows: Iterator[Row], timerValues: Any) -> Iterator[Row]:
        mark = timerValues.getCurrentWatermarkInMs() * 1000
        take = None
        for given in rows:
            take = take or itemgetter(*map(given.__fields__.index, self.names))
            row = take(given)
            yield self.row(*row, row[self.time] is not None and row[self.time] < mark)


class Neighbours(_Settling):
    """Each row beside the one before it of the same `owner`, once the watermark has passed it. Rows carry `_settled`, false.

    Kept are the rows that the watermark has not reached and, marked as settled, the last row before it of each owner."""

    def __init__(self, row: StructType, owner: str, order: Sequence[str], beside: Sequence[str]) -> None:
        super().__init__(row, order[0])
        self.owner, self.settled = row.names.index(owner), row.names.index("_settled")
        self.order = [row.names.index(c) for c in order]
        self.beside = [row.names.index(c) for c in beside]

    def output(self) -> StructType:
        kept = [f for f in self.kept.fields if f.name != "_settled"]
        return StructType([KIND, *kept, *(StructField(f"prev_{f.name}", f.dataType) for f in (self.kept[k] for k in self.beside))])

    def _out(self, kind: str, row: tuple, before: tuple | None) -> Row:
        values = [v for k, v in enumerate(row) if k != self.settled]
        return self.row(kind, *values, *(before[k] if before else None for k in self.beside))

    def late(self, row: tuple) -> Row:
        return self._out("late", row, None)

    def _place(self, row: tuple) -> tuple:
        return ordered_by([row[self.owner], *(row[k] for k in self.order)])

    def settle(self, rows: list[tuple], mark: int) -> tuple[Iterable[Row], list[tuple]]:
        last: dict[Any, tuple] = {}
        found, rest = [], []
        for row in sorted(rows, key=self._place):
            if row[self.time] >= mark:
                rest.append(row)
                continue
            owner = row[self.owner]
            if not row[self.settled] and owner in last:
                found.append(self._out("pair", row, last[owner]))
            last[owner] = (*row[: self.settled], True, *row[self.settled + 1 :])
        return found, [*last.values(), *rest]

    def due(self, rows: list[tuple]) -> int | None:
        return min((r[self.time] for r in rows if not r[self.settled]), default=None)


class Versions(_Settling):
    """Versions of a key's change records. Kept are the records that the watermark has not reached and the last one before
    it, with the order values of the first record of its version."""

    def __init__(self, row: StructType, order: Sequence[str], track: Sequence[str], watermark: bool = True) -> None:
        super().__init__(row, order[0], watermark)
        self.order = [row.names.index(c) for c in order]
        self.origin = [row.names.index(f"_from_{c}") for c in order]
        self.deleted = row.names.index("_deleted")
        self.tracked = [self.deleted, *(row.names.index(c) for c in track)]

    def output(self) -> StructType:
        return StructType([KIND, *self.kept.fields, StructField("_next", self.kept[self.time].dataType)])

    def late(self, row: tuple) -> Row:
        return self.row("late", *row, None)

    def _place(self, row: tuple) -> tuple:
        return ordered_by([row[k] for k in self.order])

    def runs(self, rows: list[tuple]) -> list[list[tuple]]:
        out: list[list[tuple]] = []
        for row in sorted(rows, key=self._place):
            if out and all(same(out[-1][-1][k], row[k]) for k in self.tracked):
                out[-1].append(row)
            else:
                out.append([row])
        return out

    def _version(self, run: list[tuple]) -> tuple:
        """The last record of a run with the order values of its first."""
        last = list(run[-1])
        for k in self.origin:
            last[k] = run[0][k]
        return tuple(last)

    def settle(self, rows: list[tuple], mark: int) -> tuple[Iterable[Row], list[tuple]]:
        runs = self.runs(rows)
        begin = self.origin[0]
        done = 0
        while done + 1 < len(runs) and (runs[done + 1][0][begin] is None or runs[done + 1][0][begin] < mark):
            done += 1
        ended = [self.row("version", *self._version(run), runs[k + 1][0][begin]) for k, run in enumerate(runs[:done]) if not run[-1][self.deleted]]
        open_, later = runs[done], [r for run in runs[done + 1 :] for r in run]
        passed = [r for r in open_ if r[self.time] is None or r[self.time] < mark]
        seed = [self._version(passed)] if passed else []
        return ended, [*seed, *open_[len(passed) :], *later]

    def due(self, rows: list[tuple]) -> int | None:
        """The start of the second version ends the first."""
        runs = self.runs(rows)
        return runs[1][0][self.origin[0]] if len(runs) > 1 else None
