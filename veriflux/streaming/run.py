"""Starting streaming queries, and reading the state that they keep."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

# State lives in RocksDB on the executors; a checkpoint gets what a micro-batch changed. Both are compressed, RocksDB in blocks of
# many rows, and it takes no disk ahead of use: 4 MB for each partition otherwise. A micro-batch removes its shuffle files when it
# ends; Spark would keep them until the driver happens to collect its garbage.
KEYED_STATE = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    "spark.sql.streaming.stateStore.compression.codec": "zstd",
    "spark.sql.streaming.stateStore.rocksdb.compression": "zstd",
    "spark.sql.streaming.stateStore.rocksdb.blockSizeKB": "32",
    "spark.sql.streaming.stateStore.rocksdb.allowFAllocate": "false",
    "spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true",
}


@contextmanager
def keyed_state(spark: SparkSession) -> Iterator[None]:
    """Queries started within keep their state in RocksDB; a query keeps the settings that it was started with."""
    before = {key: spark.conf.get(key, None) for key in KEYED_STATE}
    try:
        for key, value in KEYED_STATE.items():
            spark.conf.set(key, value)
        yield
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def watermarked(df: DataFrame, column: str, lateness: str, name: str) -> DataFrame:
    """Adds the time `name` with a watermark: the one that the stream already has on `column`, or one that lies `lateness`
    behind. A stream cannot have two of them."""
    if "spark.watermarkDelayMs" in (df.schema[column].metadata or {}):
        return df.withColumn(name, F.col(column))
    return df.withColumn(name, F.col(column).cast("timestamp")).withWatermark(name, lateness)


def _triggered(writer: DataStreamWriter, checkpoint: str, every: str | None) -> DataStreamWriter:
    writer = writer.option("checkpointLocation", checkpoint)
    return writer.trigger(processingTime=every) if every else writer.trigger(availableNow=True)


def to_files(df: DataFrame, path: str, checkpoint: str, every: str | None = None) -> StreamingQuery:
    """Appends to Parquet; without `every` it processes what is there and stops."""
    writer = df.writeStream.format("parquet").outputMode("append")
    with keyed_state(df.sparkSession):
        return _triggered(writer, checkpoint, every).start(path)


def to_batches(
    df: DataFrame, handle: Callable[[DataFrame, int], None], checkpoint: str, every: str | None = None, mode: str = "append"
) -> StreamingQuery:
    with keyed_state(df.sparkSession):
        return _triggered(df.writeStream.outputMode(mode).foreachBatch(handle), checkpoint, every).start()


def drain(query: StreamingQuery) -> None:
    query.awaitTermination()


def state_rows(spark: SparkSession, checkpoint: str, variable: str | None = None) -> DataFrame:
    """What a query's keyed state holds after its last complete micro-batch: `key` and `value`, or one row for each
    element of a list (`list_element`). Read partition by partition from the checkpoint."""
    with keyed_state(spark):
        reader = spark.read.format("statestore")
        if variable:
            reader = reader.option("stateVarName", variable)
        return reader.load(checkpoint)
