"""Change streams applied to type 1 and type 2 tables. The tables are Spark's own keyed state: RocksDB on the executors,
and below the checkpoint what each micro-batch changed. A micro-batch reads and writes the state of the keys it holds."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructField, StructType

from veriflux.operators.cdc import apart, change_rows, current_rows, history_rows, neighbours, versions, winners
from veriflux.operators.ordered import SkewPolicy
from veriflux.streaming.keyed import Versions, as_micros, as_times
from veriflux.streaming.run import drain, keyed_state, state_rows, to_batches, watermarked


class Scd1Stream:
    """Current rows per key, in any order of arrival: a running aggregate that keeps, per column, the value with the highest
    sequence. Changes of a key are merged before they are shuffled, so a hot key costs a row per task. Unless the sequence is
    promised to be unique, columns next to each other share its place in the state where records have values in all of them."""

    def __init__(
        self,
        changes: DataFrame,
        path: str,
        keys: Sequence[str],
        sequence: Sequence[str],
        exclude: Sequence[str] = (),
        ignore_null_updates: bool = True,
        delete_when: Column | None = None,
        unique_sequence: bool = False,
    ):
        columns = [c for c in changes.columns if c not in {*keys, *exclude}]
        self.spark, self.keys, self.path = changes.sparkSession, list(keys), path
        self.together = neighbours(columns, unique_sequence)
        self.merged = winners(changes, keys, sequence, columns, ignore_null_updates, delete_when, unique_sequence, self.together)

    def start(self, every: str | None = None, publish: Callable[[DataFrame, int], None] | None = None) -> StreamingQuery:
        """`publish` gets the current rows of the keys that a micro-batch changed, deleted ones left out; after a lost
        driver the last micro-batch may come again under its number."""

        def changed(batch: DataFrame, batch_id: int) -> None:
            rows = current_rows(apart(batch, self.together), self.keys)
            publish(rows, batch_id) if publish else rows.write.format("noop").mode("overwrite").save()

        return to_batches(self.merged, changed, f"{self.path}/checkpoint", every, "update")

    def run(self) -> None:
        """Processes what is there."""
        drain(self.start())

    def table(self) -> DataFrame:
        """The current rows after the last complete micro-batch."""
        state = state_rows(self.spark, f"{self.path}/checkpoint")
        # Buffers are named after their aggregates, in the order of the columns.
        names = self.merged.schema
        buffers = "struct<" + ",".join(f"`{c}`:{names[c].dataType.simpleString()}" for c in names.names[len(self.keys) :]) + ">"
        keys = [F.col("key")[k].alias(k) for k in self.keys]
        merged = state.select(*keys, F.col("value").cast(buffers).alias("value")).select(*self.keys, "value.*")
        return current_rows(apart(merged, self.together), self.keys)


class Scd2Stream:
    """History rows of keys whose records come in any order.

    With `lateness` (the first sequence column is a time then), records behind the watermark go to `late()`, and a version that
    the watermark shows to be complete is written once and leaves the state: what stays is the last record before the watermark
    and all later ones. Timers see to it for keys of which nothing more comes.

    Without `lateness` no record is late and no version is ever complete: the state is the set of all records, each under a key
    of its own, so that a micro-batch reads and writes its own records and a hot key is spread over the tasks. `history()`
    derives the versions from it. Full copies of a record are kept once.
    """

    def __init__(
        self,
        changes: DataFrame,
        path: str,
        keys: Sequence[str],
        sequence: Sequence[str],
        track: Sequence[str],
        policy: SkewPolicy = SkewPolicy(),
        delete_when: Column | None = None,
        lateness: str | None = None,
    ):
        self.spark, self.path, self.policy, self.lateness = changes.sparkSession, path, policy, lateness
        self.keys, self.sequence, self.order = list(keys), list(sequence), [*sequence, "_tie"]
        self.columns, self.track = changes.columns, list(track)

        def prepared(rows: DataFrame) -> DataFrame:
            rows = change_rows(rows, keys, delete_when)
            return rows.withColumns({f"_from_{c}": F.col(c) for c in self.order}) if lateness else rows

        self.given = prepared(changes).schema
        self.processor = Versions(as_micros(prepared(changes)).schema, self.order, track) if lateness else None
        if lateness:
            changes = watermarked(changes, sequence[0], lateness, "_at")
        # As numbers, times carry no watermark that would make the set of records forget some.
        self.rows = as_micros(prepared(changes).select(*self.given.names))

    def start(self, every: str | None = None) -> StreamingQuery:
        if self.processor:
            found = self.rows.groupBy(*self.keys).transformWithState(self.processor, self.processor.output(), "append", "eventTime")
            writer = self._timed(found).writeStream.format("parquet").partitionBy("kind").option("path", f"{self.path}/ended")
        else:
            writer = self.rows.dropDuplicates().writeStream.format("noop")
        writer = writer.outputMode("append").option("checkpointLocation", f"{self.path}/checkpoint")
        with keyed_state(self.spark):
            return (writer.trigger(processingTime=every) if every else writer.trigger(availableNow=True)).start()

    def run(self) -> None:
        """Processes what is there."""
        drain(self.start())

    def _timed(self, rows: DataFrame) -> DataFrame:
        ends = StructField("_next", self.given[self.sequence[0]].dataType)
        return as_times(rows, StructType([*self.given.fields, ends]))

    def _written(self, kind: str) -> DataFrame:
        empty = self._timed(self.spark.createDataFrame([], self.processor.output()))
        return self.spark.read.schema(empty.schema).parquet(f"{self.path}/ended").filter(F.col("kind") == kind)

    def late(self) -> DataFrame:
        """Records that came behind the watermark."""
        if not self.processor:
            return self.kept_rows().select(*self.columns).limit(0)
        return self._written("late").select(*self.columns)

    def kept_rows(self) -> DataFrame:
        """The records in the state."""
        if self.processor:
            rows = state_rows(self.spark, f"{self.path}/checkpoint", "rows").select("list_element.*")
        else:
            rows = state_rows(self.spark, f"{self.path}/checkpoint").select("key.*")
        return as_times(rows.select(*self.given.names), self.given)

    def history(self) -> DataFrame:
        if not self.processor:
            runs = versions(self.kept_rows(), self.keys, self.order, self.track, self.policy)
            return history_rows(runs, self.columns, self.sequence)
        origin = F.struct(*[F.col(f"_from_{c}").alias(c) for c in self.order])
        kept = self.kept_rows().withColumn("_origin", origin)
        kept = kept.drop(*[f"_from_{c}" for c in self.order])
        runs = versions(kept, self.keys, self.order, self.track, self.policy, origin=F.col("_origin"))
        ended = history_rows(self._written("version"), self.columns, self.sequence)
        return ended.unionByName(history_rows(runs, self.columns, self.sequence))
