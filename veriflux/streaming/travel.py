"""Impossible travel on a stream: a transaction waits for the watermark, then it is paired with the one before it."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from veriflux.operators.ordered import SkewPolicy
from veriflux.params import RiskParams
from veriflux.plans.gold import TRAVEL_ORDER, TRAVEL_STATE, is_travel, measured, pairable, score_travel, with_previous
from veriflux.streaming.keyed import Neighbours, as_micros, as_times
from veriflux.streaming.run import drain, keyed_state, state_rows, watermarked

LATENESS = "30 minutes"


class TravelStream:
    """Pairs each transaction with its predecessor, also when transactions arrive out of order.

    The watermark is the latest event time of the earlier micro-batches less `lateness`, unless the stream has one already. A transaction behind it goes
    to `late()` and takes part in no pair. A pair is settled, and written once, when the watermark passes its later
    transaction; timers see to it for customers of whom nothing more comes. `found()` adds the pairs of transactions that the
    watermark has not reached yet, as they stand: it equals the batch dataset over all rows that are not late. Transactions
    without a time go to `late()` once there is a watermark, and make no pair before. Those without a customer
    count as one customer, as in the batch dataset, unless the parameters leave them out.

    State is Spark's own, keyed by customer: the last settled transaction and all later ones. A micro-batch reads and
    writes the state of the customers it holds and of those whose timers fire, however many others there are. With
    `groups`, customers share that many keys by hash: fewer calls, but each reads the state of its whole group.
    """

    def __init__(
        self,
        transactions: DataFrame,
        path: str,
        params: RiskParams = RiskParams(),
        policy: SkewPolicy = SkewPolicy(),
        lateness: str = LATENESS,
        groups: int | None = None,
    ):
        self.path, self.params, self.policy, self.lateness, self.groups = path, params, policy, lateness, groups
        self.spark = transactions.sparkSession
        self.given = pairable(transactions, params)
        rows = as_micros(self.given).withColumn("_settled", F.lit(False))
        self.kept = rows.schema
        self.processor = Neighbours(rows.schema, "customer_id", TRAVEL_ORDER, TRAVEL_STATE)
        # Rows behind the watermark have to reach the processor: it sees no column that carries the watermark.
        marked = watermarked(self.given, "event_timestamp", lateness, "_at")
        self.rows = as_micros(marked).withColumn("_settled", F.lit(False)).drop("_at")

    def start(self, every: str | None = None) -> StreamingQuery:
        rows = self.rows.filter(F.col("event_timestamp").isNotNull())
        owner = F.pmod(F.xxhash64("customer_id"), F.lit(self.groups)) if self.groups else F.col("customer_id")
        found = rows.withColumn("_owner", owner).groupBy("_owner").transformWithState(
            self.processor, self.processor.output(), "append", "eventTime")
        found = self._timed(found).withColumn("_found_at", F.current_timestamp())
        found = measured(found).filter((F.col("kind") == "late") | is_travel(self.params)).drop("_km", "_hours")
        writer = found.writeStream.format("parquet").outputMode("append").partitionBy("kind")
        writer = writer.option("checkpointLocation", f"{self.path}/checkpoint").option("path", f"{self.path}/found")
        with keyed_state(self.spark):
            return (writer.trigger(processingTime=every) if every else writer.trigger(availableNow=True)).start()

    def run(self) -> None:
        """Processes what is there."""
        drain(self.start())

    def _timed(self, rows: DataFrame) -> DataFrame:
        return as_times(rows, self.given.schema, ("", "prev_"))

    def _written(self, kind: str) -> DataFrame:
        columns = self._timed(self.spark.createDataFrame([], self.processor.output())).schema.add("_found_at", "timestamp")
        return self.spark.read.schema(columns).parquet(f"{self.path}/found").filter(F.col("kind") == kind)

    def settled(self) -> DataFrame:
        """Pairs that no later arrival changes."""
        return score_travel(self._written("pair"), self.params, F.col("_found_at"))

    def late(self) -> DataFrame:
        """Transactions that came behind the watermark."""
        return self._written("late").select(*[c for c in self.given.columns if not c.startswith("_")])

    def kept_rows(self) -> DataFrame:
        """The transactions in the state; `_settled` marks the last one behind the watermark of each customer."""
        rows = state_rows(self.spark, f"{self.path}/checkpoint", "rows").select("list_element.*")
        return as_times(rows.select(*self.kept.names), self.given.schema)

    def found(self) -> DataFrame:
        """Settled pairs, and those of transactions that the watermark has not passed."""
        waiting = with_previous(self.kept_rows(), self.policy, merge_copies=True).filter(~F.col("_settled"))
        return self.settled().unionByName(score_travel(waiting, self.params))
