"""The live path: messages to alerts, current transactions and dead letters."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from veriflux.operators import quality
from veriflux.params import RiskParams
from veriflux.plans import bronze, silver
from veriflux.sources import bus
from veriflux.streaming.alerts import alerts_once
from veriflux.streaming.run import drain, to_files
from veriflux.streaming.upsert import Scd1Stream

OUTPUTS = ("alerts", "dead_letters")


class LivePath:
    """Message envelopes (a stream, see `sources.bus`) in, three outputs below `path`:

    `alerts()`        one alert per transaction, from the first of its messages that calls for one
    `cleaned()`       the current row of each transaction
    `dead_letters()`  messages that cannot be used, with the first reason that applies

    Every message counts for `dead_letters` or for the two others. Each output is a query of its own with its own
    checkpoint: one that was lost goes on where it stopped, whatever the others did.
    """

    def __init__(self, envelopes: DataFrame, path: str, params: RiskParams = RiskParams(), source_zone: str | None = None) -> None:
        self.spark, self.path = envelopes.sparkSession, path
        raw = bronze.transactions_raw(envelopes, source_zone)
        valid, _ = quality.split(raw, bus.is_malformed())
        valid = valid.drop(bus.CORRUPT)
        self._alerts = alerts_once(valid, params)
        self._dead = bronze.dead_letter(raw, bus.is_malformed())
        excluded = [c for c in silver.TRANSPORT_COLUMNS if c in valid.columns]
        self._current = Scd1Stream(valid, f"{path}/cleaned", ["transaction_id"], ["_kafka_timestamp", "_kafka_offset"], excluded)

    def start(self, every: str | None = None) -> list[StreamingQuery]:
        """Without `every` the queries process what is there and stop."""
        outputs = {"alerts": self._alerts, "dead_letters": self._dead}
        files = [to_files(rows, f"{self.path}/{name}", f"{self.path}/checkpoints/{name}", every) for name, rows in outputs.items()]
        return [*files, self._current.start(every)]

    def run(self) -> None:
        """Processes what is there."""
        for query in self.start():
            drain(query)

    def _written(self, name: str, rows: DataFrame) -> DataFrame:
        return self.spark.read.schema(rows.schema).parquet(f"{self.path}/{name}")

    def alerts(self) -> DataFrame:
        return self._written("alerts", self._alerts)

    def dead_letters(self) -> DataFrame:
        return self._written("dead_letters", self._dead)

    def cleaned(self) -> DataFrame:
        return self._current.table()
