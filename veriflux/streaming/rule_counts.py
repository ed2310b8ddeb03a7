"""Rule counts of running streams, stored per micro-batch."""

from __future__ import annotations

import threading
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from veriflux.operators.quality import ROWS

SCHEMA = "name string, rule string, failed bigint, total bigint, query string, batch bigint"


class RuleCounts(StreamingQueryListener):
    """Writes the counts of `quality.track_stream` below `path`, in a folder for each query and micro-batch: one that is
    reported again replaces its own folder. Several streams may report to one listener."""

    def __init__(self, spark: SparkSession, path: str) -> None:
        self.spark, self.path = spark, path
        self._ended: dict[str, threading.Event] = {}

    def __enter__(self) -> RuleCounts:
        self.spark.streams.addListener(self)
        return self

    def __exit__(self, *error: object) -> None:
        self.spark.streams.removeListener(self)

    def onQueryStarted(self, event) -> None:
        self._end(str(event.runId))

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        progress = event.progress
        rows = []
        for name, metrics in (progress.observedMetrics or {}).items():
            counts = metrics.asDict()
            if ROWS in counts:
                total = counts.pop(ROWS)
                rows += [(name, rule, failed, total, str(progress.id), progress.batchId) for rule, failed in counts.items()]
        if rows:
            folder = f"{self.path}/query={progress.id}/batch={progress.batchId}"
            plain = self.spark.createDataFrame(rows, SCHEMA).drop("query", "batch").coalesce(1)
            plain.write.mode("overwrite").parquet(folder)

    def onQueryTerminated(self, event) -> None:
        self._end(str(event.runId)).set()

    def _end(self, run: str) -> threading.Event:
        return self._ended.setdefault(run, threading.Event())

    def wait(self, query: StreamingQuery, seconds: float = 60) -> None:
        """Until the query has ended and all its micro-batches are stored."""
        query.awaitTermination()
        if not self._end(str(query.runId)).wait(seconds):
            raise TimeoutError(f"the end of {query.runId} was not reported")

    def batches(self) -> DataFrame:
        """name, rule, failed, total of each query and micro-batch."""
        return self.spark.read.schema(SCHEMA).parquet(self.path)

    def report(self, keys: Sequence[str] = ("name", "rule")) -> DataFrame:
        """Sums over micro-batches: passed, failed and total rows, as `quality.report` counts them on a batch frame."""
        sums = self.batches().groupBy(*keys).agg(F.sum("failed").alias("failed"), F.sum("total").alias("total"))
        return sums.select(*keys, (F.col("total") - F.col("failed")).alias("passed"), "failed", "total")
