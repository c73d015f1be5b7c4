"""Streaming upkeep: recent refresh, sliding statistics, redelivery."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from datetime import datetime, timezone

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from skygauge.operators.anomalies import Readings

# The lookback of the recent jobs and how often they run.
LOOKBACK_WINDOW = "2 hours"
REFRESH_EVERY = "15 minutes"


def utc_now() -> datetime:
    return datetime.now(timezone.utc).replace(tzinfo=None)


def refresh_recent(
    arrivals: DataFrame,
    job: Callable[[datetime], object],
    checkpoint: str,
    trigger: dict | None = None,
    clock: Callable[[], datetime] = utc_now,
) -> StreamingQuery:
    """Run a recent job for every batch of arrivals.

    The stream only says that data came and when to look; the job re-reads its
    lookback, so late rows are seen while they are recent, and a repeated batch
    overwrites the same table.
    """
    return (
        arrivals.writeStream
        .foreachBatch(lambda batch, batch_id: job(clock()))
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"processingTime": REFRESH_EVERY}))
        .start()
    )


def sliding_stats(
    readings: DataFrame,
    kind: Readings,
    window: str = LOOKBACK_WINDOW,
    slide: str = REFRESH_EVERY,
    lateness: str = LOOKBACK_WINDOW,
) -> DataFrame:
    """Mean and sample deviation by entity over sliding event-time windows.

    ``readings`` needs a TIMESTAMP column ``timestamp``; state is one partial
    aggregate per entity and open window.
    """
    return (
        readings.withWatermark("timestamp", lateness)
        .groupBy(*kind.keys, F.window("timestamp", window, slide))
        .agg(
            F.avg(kind.value).alias(kind.mean),
            F.stddev_samp(kind.value).alias(kind.spread),
            F.count(kind.value).alias("readings"),
        )
        .select(
            *kind.keys, F.col("window.start").alias("since"),
            F.col("window.end").alias("until"), kind.mean, kind.spread, "readings",
        )
    )


def drop_redelivered(
    readings: DataFrame,
    keys: Sequence[str],
    lateness: str = LOOKBACK_WINDOW,
    parts: int = 1,
) -> DataFrame:
    """Drop repeats of a key that arrive within ``lateness`` of each other.

    State is one small row per key.  Where single readings are delivered very often,
    ``parts`` drops repeats within so many parts of the input first: one such reading is
    then spread over as many tasks and leaves at most one row in each, for a state that
    is held twice.
    """
    once = readings.withWatermark("timestamp", lateness)
    if parts > 1:
        part = F.pmod(F.spark_partition_id(), F.lit(parts))
        once = (
            once.withColumn("_part", part)
            .dropDuplicatesWithinWatermark([*keys, "_part"])
            .drop("_part")
        )
    return once.dropDuplicatesWithinWatermark(list(keys))
