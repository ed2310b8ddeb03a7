"""Messages to a topic; needs Spark's Kafka connector on the class path."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from veriflux.sources.bus import pack

# Batching and durability of the producer.
PRODUCER = {
    "kafka.batch.size": "65536",
    "kafka.linger.ms": "10",
    "kafka.compression.type": "lz4",
    "kafka.acks": "1",
    "kafka.retries": "3",
}


def publish(rows: DataFrame, servers: str, topic: str, key: str = "customer_id", **options: str) -> None:
    """Sends a batch frame as keyed JSON."""
    writer = pack(rows, key).write.format("kafka").options(**{**PRODUCER, **options})
    writer.option("kafka.bootstrap.servers", servers).option("topic", topic).save()


def publish_stream(
    rows: DataFrame, servers: str, topic: str, checkpoint: str, key: str = "customer_id", **options: str
) -> StreamingQuery:
    """Sends a stream as keyed JSON until it is stopped."""
    writer = pack(rows, key).writeStream.format("kafka").options(**{**PRODUCER, **options})
    writer = writer.option("kafka.bootstrap.servers", servers).option("topic", topic)
    return writer.option("checkpointLocation", checkpoint).start()
