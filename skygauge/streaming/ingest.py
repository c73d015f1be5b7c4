"""Ingest streams: decode messages and land them as files, readable and rejected ones.

One query reads a topic.  Each batch is parsed once and split into the rows that can be
read and the messages that cannot.  Both are written aside first and then moved into
their tables under names that begin with the batch, so that a batch that is repeated
after a failure replaces its own files, and readers meet no file that is half written.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence
from dataclasses import dataclass
from datetime import datetime, timezone

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from skygauge import files, schemas
from skygauge.functions.payloads import decode_json, readable, unreadable
from skygauge.functions.times import landing_time, partition_dates

#: Folder of a landed table for what is not in its place yet; readers pass over it.
PENDING = "_landing"


def _counted(decoded: DataFrame) -> DataFrame:
    return decoded.observe(
        "decode",
        F.count(F.lit(1)).alias("messages"),
        F.count("_unreadable").alias("unreadable"),
    )


def date_partitioned(measurements: DataFrame, ingested: Column | None = None) -> DataFrame:
    """Add the typed time, defaulted to ingestion time, and its date columns."""
    moment = F.current_timestamp() if ingested is None else ingested
    timed = measurements.withColumn("timestamp", landing_time(F.col("timestamp"), moment))
    return timed.withColumns(partition_dates(F.col("timestamp")))


def by_date(rows: DataFrame, ingested: Column | None = None) -> DataFrame:
    """Add ingestion time and its date: few directories, whatever the number of cities."""
    moment = F.current_timestamp() if ingested is None else ingested
    return rows.withColumns({"ingest_ts": moment, "ingest_date": F.to_date(moment)})


def by_city_and_date(observations: DataFrame, ingested: Column | None = None) -> DataFrame:
    """Add ingestion time, its date, and the city as a directory column."""
    return by_date(observations, ingested).withColumn("city_key", F.col("city"))


@dataclass(frozen=True)
class Landing:
    """How the messages of a topic become files."""

    schema: T.StructType
    rows: Callable[[DataFrame, Column], DataFrame]
    folders: tuple[str, ...]
    form: str


AIR_QUALITY = Landing(schemas.AIR_QUALITY_MESSAGE, date_partitioned, ("year", "month", "day"), "parquet")
WEATHER = Landing(schemas.WEATHER, by_city_and_date, ("city_key", "ingest_date"), "json")
WEATHER_BY_DATE = Landing(schemas.WEATHER, by_date, ("ingest_date",), "json")
#: What is not read: the text, when it came, in folders by date.
REJECTED = Landing(
    T.StructType([T.StructField("value", T.StringType())]), by_date, ("ingest_date",), "parquet")


def land(
    messages: DataFrame, kind: Landing, path: str, rejected: str, checkpoint: str, trigger: dict | None = None
) -> StreamingQuery:
    """Stream a topic into the table at ``path``, and what cannot be read to ``rejected``.

    Whatever happens between the two writes, or between a write and the query's own
    note of it, a restart lands each message once: a batch keeps its ingestion time,
    so it comes to the same folders again, where its earlier files go first.  The
    progress of the query counts messages and unreadable ones (metric ``decode``).
    """
    spark = messages.sparkSession
    for table in (path, rejected):
        if files.exists(spark, f"{table}/_spark_metadata"):
            raise ValueError(f"{table} was written by a file sink, whose log hides other files; land elsewhere")

    def write(batch: DataFrame, number: int) -> None:
        session = batch.sparkSession
        name, ingested = _batch(session, checkpoint, number)
        decoded = batch.persist(StorageLevel.DISK_ONLY)
        try:
            _place(session, kind.rows(readable(decoded), ingested), kind, path, name)
            _place(session, REJECTED.rows(unreadable(decoded), ingested), REJECTED, rejected, name)
        finally:
            decoded.unpersist()

    decoded = _counted(decode_json(messages.select("value"), "value", kind.schema))
    return (
        decoded.writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"processingTime": "30 seconds"}))
        .start()
    )


def _batch(spark: SparkSession, checkpoint: str, number: int) -> tuple[str, Column]:
    """Name of a batch and its ingestion time, the same at each attempt.

    The name begins with the checkpoint's own: batches of a query that was started
    anew do not replace those of an earlier one.
    """
    home = f"{checkpoint}/landing"
    owner = files.read_text(spark, f"{home}/owner")
    if owner is None:
        owner = uuid.uuid4().hex[:12]
        files.write_text(spark, f"{home}/owner", owner)
    noted = files.read_text(spark, f"{home}/batch-{number}")
    if noted is None:
        noted = datetime.now(timezone.utc).replace(tzinfo=None).isoformat(timespec="microseconds")
        files.write_text(spark, f"{home}/batch-{number}", noted)
        files.remove(spark, f"{home}/batch-{number - 2}")
    return f"batch-{owner}-{number:09d}", F.lit(noted).cast("timestamp")


def _place(spark: SparkSession, rows: DataFrame, kind: Landing, path: str, name: str) -> None:
    """Write a batch aside, then move its files into their folders in place of earlier ones.

    The folder aside stays, empty, until the next batch comes: as long as it is there
    the batch may be repeated, and compaction leaves its files alone.
    """
    aside = f"{path}/{PENDING}/{name}"
    (rows.hint("rebalance", *kind.folders).write.mode("overwrite").partitionBy(*kind.folders)
     .format(kind.form).save(aside))
    for other in files.entries(spark, f"{path}/{PENDING}"):
        if other.name != name and other.name.rpartition("-")[0] == name.rpartition("-")[0]:
            files.remove(spark, other.path)
    prefix = f"/{PENDING}/{name}/"
    found = [e for e in files.files_below(spark, aside) if e.name.startswith("part-")]
    folders: dict[str, list[str]] = {}
    for entry in found:
        inside = entry.path[entry.path.index(prefix) + len(prefix):].rpartition("/")[0]
        folders.setdefault(inside, []).append(entry.path)
    for folder in folders:
        for earlier in files.entries(spark, f"{path}/{folder}"):
            if earlier.name.startswith(f"{name}-"):
                files.remove(spark, earlier.path)
    for folder, sources in folders.items():
        for part, source in enumerate(sources):
            ending = source.rpartition("/")[2].partition(".")[2]
            files.move(spark, source, f"{path}/{folder}/{name}-{part:05d}.{ending}")


def land_air_quality(
    messages: DataFrame, path: str, checkpoint: str, trigger: dict | None = None, rejected: str | None = None
) -> StreamingQuery:
    """Stream air-quality messages to Parquet by year, month and day of each row."""
    return land(messages, AIR_QUALITY, path, rejected or f"{path}_rejected", checkpoint, trigger)


def land_weather(
    messages: DataFrame,
    path: str,
    checkpoint: str,
    trigger: dict | None = None,
    by_city: bool = True,
    rejected: str | None = None,
) -> StreamingQuery:
    """Stream weather messages to JSON by city and ingestion date.

    With many cities ``by_city=False`` keeps the files of a batch few: directories
    by ingestion date only, which is what the recent read prunes on.
    """
    kind = WEATHER if by_city else WEATHER_BY_DATE
    return land(messages, kind, path, rejected or f"{path}_rejected", checkpoint, trigger)


def read_rejected(spark: SparkSession, path: str) -> DataFrame:
    """value, ingest_ts, ingest_date of the messages that were set aside; no rows before the first."""
    schema = T.StructType([*REJECTED.schema.fields, T.StructField("ingest_ts", T.TimestampType())])
    if not files.exists(spark, path):
        return spark.createDataFrame([], schema.add("ingest_date", T.DateType()))
    return spark.read.schema(schema.add("ingest_date", T.DateType())).parquet(path)


def pending_batches(spark: SparkSession, path: str) -> Sequence[str]:
    """Names of the batches of a landed table that may be repeated."""
    return [e.name for e in files.entries(spark, f"{path}/{PENDING}")]
