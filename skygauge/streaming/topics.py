"""Kafka topics as streaming sources and sinks.

The connector package must be on the cluster's class path; the decode and land
stages take any streaming DataFrame with a ``value`` column.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from skygauge.functions.payloads import encode_json

# The topics, and the flush rule "100 rows or 30 seconds".
TOPICS = ("airquality", "weather")
FLUSH_ROWS = 100
FLUSH_DELAY = "30s"

#: Trigger of a query on a topic: whenever the source's options let a batch start.
WHEN_FLUSHED = {"processingTime": "0 seconds"}


def topic_options(
    servers: str, topic: str, flush_rows: int = FLUSH_ROWS, flush_delay: str = FLUSH_DELAY
) -> dict[str, str]:
    """Source options: from the earliest offset, small batches held back briefly.

    A batch starts at the row count or the delay, whichever comes first, and
    takes everything available, so throughput has no ceiling.
    """
    return {
        "kafka.bootstrap.servers": servers,
        "subscribe": topic,
        "startingOffsets": "earliest",
        "minOffsetsPerTrigger": str(flush_rows),
        "maxTriggerDelay": flush_delay,
    }


def topic_source(spark: SparkSession, servers: str, topic: str, **flush) -> DataFrame:
    """Messages of a topic as a stream with a ``value`` column."""
    reader = spark.readStream.format("kafka").options(**topic_options(servers, topic, **flush))
    return reader.load().select("value")


def publish(df: DataFrame, servers: str, topic: str, checkpoint: str | None = None):
    """Send each row as one JSON message; a stream needs a ``checkpoint``."""
    messages = encode_json(df)
    target = {"kafka.bootstrap.servers": servers, "topic": topic}
    if not df.isStreaming:
        return messages.write.format("kafka").options(**target).save()
    return (
        messages.writeStream.format("kafka").options(**target)
        .option("checkpointLocation", checkpoint).start()
    )
