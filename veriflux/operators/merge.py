"""Tables that take deliveries of change records and shuffle only these.

A table is bucketed by its keys, so joins by key read it where it lies, and partitioned by a hash of the keys, so that a delivery
rewrites only the parts that hold its keys. Parts and buckets are plain Spark: `partitionBy`, `bucketBy` and
dynamic partition overwrite.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from veriflux.operators.cdc import change_rows, current_rows, history_rows, versions, winners
from veriflux.operators.ordered import SkewPolicy

PART = "_part"
DYNAMIC = "spark.sql.sources.partitionOverwriteMode"


# A task of a merge handles one bucket.
BUCKET_ROWS = 200_000


def buckets_for(spark: SparkSession, rows: int) -> int:
    """Buckets for a table that is to hold about so many records: tasks stay of one size however large it is."""
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-rows // BUCKET_ROWS))


@contextmanager
def _dynamic_overwrite(spark: SparkSession) -> Iterator[None]:
    before = spark.conf.get(DYNAMIC)
    spark.conf.set(DYNAMIC, "dynamic")
    try:
        yield
    finally:
        spark.conf.set(DYNAMIC, before)


class _Bucketed:
    """One stored table, below `path` if that is given."""

    def __init__(self, spark: SparkSession, name: str, keys: Sequence[str], parts: int, buckets: int, path: str | None) -> None:
        self.spark, self.name, self.keys, self.parts, self.buckets = spark, name, list(keys), parts, buckets
        self.path = path

    def exists(self) -> bool:
        return self.spark.catalog.tableExists(self.name)

    def _laid_out(self, rows: DataFrame) -> DataFrame:
        part = F.pmod(F.xxhash64(*self.keys), F.lit(self.parts)).cast("int")
        return rows.withColumn(PART, part)

    def create(self, rows: DataFrame) -> None:
        writer = self.aligned(self._laid_out(rows)).write.format("parquet").mode("errorifexists")
        writer = writer.partitionBy(PART).bucketBy(self.buckets, *self.keys).sortBy(*self.keys)
        (writer.option("path", self.path) if self.path else writer).saveAsTable(self.name)

    def append(self, rows: DataFrame) -> None:
        columns = self.spark.table(self.name).columns
        self.aligned(self._laid_out(rows)).select(*columns).write.insertInto(self.name)

    def replace(self, rows: DataFrame) -> None:
        """Rewrites the parts that occur in `rows`, which has to hold all their rows."""
        with _dynamic_overwrite(self.spark):
            rows.select(*self.spark.table(self.name).columns).write.insertInto(self.name, overwrite=True)

    def aligned(self, rows: DataFrame) -> DataFrame:
        """Dealt like the buckets: a join by key moves these rows and not the stored ones."""
        return rows.repartition(self.buckets, *self.keys)

    def touched(self, changes: DataFrame) -> list[int]:
        """The parts that hold keys of the changes: at most `parts` numbers."""
        return sorted(r[PART] for r in self._laid_out(changes).select(PART).distinct().collect())

    def read(self, parts: Sequence[int] | None = None) -> DataFrame:
        rows = self.spark.table(self.name)
        return rows if parts is None else rows.filter(F.col(PART).isin([int(p) for p in parts]))


class _Merged:
    """What both kinds of table share. Records without a key cannot be merged: they are kept in `quarantine`."""

    def __init__(self, spark: SparkSession, name: str, keys: Sequence[str], parts: int, buckets: int | None, path: str | None) -> None:
        self.spark, self.keys, self.name = spark, list(keys), name
        buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
        self._table = lambda suffix: _Bucketed(spark, f"{name}{suffix}", keys, parts, buckets, path and f"{path}/{suffix or 'current'}")
        self.quarantine_name, self.quarantine_path = f"{name}_quarantine", path and f"{path}/_quarantine"

    def _keyed(self, changes: DataFrame) -> DataFrame:
        whole = F.lit(True)
        for key in self.keys:
            whole = whole & F.col(key).isNotNull()
        writer = changes.filter(~whole).write.format("parquet").mode("append")
        (writer.option("path", self.quarantine_path) if self.quarantine_path else writer).saveAsTable(self.quarantine_name)
        return changes.filter(whole)

    def quarantine(self) -> DataFrame:
        return self.spark.table(self.quarantine_name)


class Scd1Table(_Merged):
    """Current row per key, kept up to date by deliveries in any order; a delivery that comes twice changes nothing but `quarantine`."""

    def __init__(
        self, spark: SparkSession, name: str, keys: Sequence[str], sequence: Sequence[str], exclude: Sequence[str] = (),
        ignore_null_updates: bool = True, delete_when: Column | None = None, unique_sequence: bool = False,
        parts: int = 16, buckets: int | None = None, path: str | None = None,
    ):
        super().__init__(spark, name, keys, parts, buckets, path)
        self.state = self._table("")

        def partial(changes: DataFrame) -> DataFrame:
            columns = [c for c in changes.columns if c not in {*keys, *exclude}]
            return winners(changes, keys, sequence, columns, ignore_null_updates, delete_when, unique_sequence)

        self._partial = partial

    def merged(self, changes: DataFrame, parts: Sequence[int]) -> DataFrame:
        """The touched parts after the delivery: a full join by key, column by column the value with the higher sequence."""
        fresh = self.state.aligned(self.state._laid_out(self._partial(changes)))
        values = [c for c in fresh.columns if c not in {*self.keys, PART}]
        stored = self.state.read(parts).alias("s")
        both = stored.join(fresh.alias("f"), self.keys, "full_outer")
        return both.select(
            *self.keys, *[F.greatest(F.col(f"s.{c}"), F.col(f"f.{c}")).alias(c) for c in values], F.coalesce(f"s.{PART}", f"f.{PART}").alias(PART))

    def apply(self, changes: DataFrame) -> None:
        changes = self._keyed(changes)
        if not self.state.exists():
            self.state.create(self._partial(changes))
            return
        parts = self.state.touched(changes)
        if parts:
            self.state.replace(self.merged(changes, parts))

    def table(self) -> DataFrame:
        return current_rows(self.state.read().drop(PART), self.keys)


class Scd2Table(_Merged):
    """History rows, kept up to date by deliveries in any order; a delivery that comes twice changes nothing but `quarantine`.

    The log holds all records; from it the versions of the keys of a delivery are derived again, so a late record
    may split any version. The log is extended last: a delivery whose job was lost is applied again as a whole. Parts lost
    while they were being replaced are derived from the log by `rebuild`.
    """

    def __init__(
        self, spark: SparkSession, name: str, keys: Sequence[str], sequence: Sequence[str], track: Sequence[str],
        policy: SkewPolicy = SkewPolicy(), delete_when: Column | None = None,
        parts: int = 16, buckets: int | None = None, path: str | None = None,
    ):
        super().__init__(spark, name, keys, parts, buckets, path)
        self.sequence, self.policy = list(sequence), policy
        self.order = [*sequence, "_tie"]
        self.log, self.runs = self._table("_log"), self._table("")
        self._prepare = lambda rows: change_rows(rows, keys, delete_when)
        self._versions = lambda rows: versions(rows, self.keys, self.order, track, policy)

    def touched_keys(self, rows: DataFrame) -> DataFrame:
        return self.log.aligned(rows.select(*self.keys).distinct())

    def known(self, keys: DataFrame, parts: Sequence[int]) -> DataFrame:
        """The logged records of these keys."""
        return self.log.read(parts).join(keys, self.keys, "left_semi").drop(PART)

    def untouched(self, keys: DataFrame, parts: Sequence[int]) -> DataFrame:
        """The versions of all other keys of these parts."""
        return self.runs.read(parts).join(keys, self.keys, "left_anti")

    def derived(self, keys: DataFrame, parts: Sequence[int], rows: DataFrame) -> DataFrame:
        """The versions of these keys from the logged and the given records, one task for each bucket."""
        return self._versions(self.log.aligned(self.known(keys, parts).unionByName(rows)))

    def apply(self, changes: DataFrame) -> None:
        rows = self._prepare(self._keyed(changes))
        if not self.log.exists():
            self.log.create(rows)
            self.runs.create(self._versions(self.log.read().drop(PART)))
            return
        parts = self.log.touched(rows)
        if parts:
            keys = self.touched_keys(rows)
            derived = self.runs._laid_out(self.derived(keys, parts, rows))
            self.runs.replace(self.untouched(keys, parts).unionByName(derived))
            self.log.append(rows)

    def rebuild(self, parts: Sequence[int]) -> None:
        """Derives all versions of these parts from the log."""
        self.runs.replace(self.runs._laid_out(self._versions(self.log.read(parts).drop(PART))))

    def history(self) -> DataFrame:
        inner = {PART, "_tie", "_deleted"}
        columns = [c for c in self.log.read().columns if c not in inner]
        return history_rows(self.runs.read(), columns, self.sequence)
