"""Stored tables by name: versions published whole, layouts, preview.

A table is a folder of versions.  A writer fills a version of its own and publishes it
at the end by one small file, so that readers meet the last whole version: a write that
fails leaves the table as it was, and a query that has begun keeps its files, since
replaced versions stay for a while.
"""

from __future__ import annotations

import hashlib
import time
import uuid
from collections.abc import Iterator, Sequence
from contextlib import contextmanager
from dataclasses import dataclass
from datetime import datetime, timezone

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skygauge import files
from skygauge.session import STALE_SECONDS

# Where each table lies under its zone.
RAW_PATHS = {
    "airquality": "airquality",
    "weather": "weather",
    "airquality_anomalies": "anomalies/airquality",
    "weather_anomalies": "anomalies/weather",
    "weather_recent_anomalies": "anomalies/weather_recent",
    "airquality_rejected": "rejected/airquality",
    "weather_rejected": "rejected/weather",
    "weather_unreadable_lines": "rejected/weather_lines",
}
REFINED_PATHS = {
    "weather": "weather_with_coords",
    "weather_anomalies": "weather_anomalies_with_coords",
    "weather_recent_anomalies": "weather_recent_anomalies_with_coords",
    "airquality": "airquality_with_coords",
    "airquality_anomalies": "airquality_anomalies_with_coords",
    "airquality_recent_anomalies": "airquality_recent_anomalies_with_coords",
}


@dataclass(frozen=True)
class Lake:
    """Roots of the raw and the refined zone, and the city file."""

    raw: str
    refined: str
    cities: str

    def raw_path(self, name: str) -> str:
        return f"{self.raw.rstrip('/')}/{RAW_PATHS[name]}"

    def refined_path(self, name: str) -> str:
        return f"{self.refined.rstrip('/')}/{REFINED_PATHS[name]}"

    def job(self, name: str) -> str:
        """Name of a job on this lake, for its intermediate tables."""
        zones = f"{self.raw} {self.refined}".encode()
        return f"{name}-{hashlib.sha256(zones).hexdigest()[:16]}"


#: How long a replaced version stays for the queries that read it.
KEEP_SECONDS = 6 * 3600
#: Columns by which the rows of a table by day are counted when it is written.
INDEXED = ("uf", "city")

_VERSION, _PUBLISHED, _ROWS = "v-", "_published", "_rows"


def current(spark: SparkSession, path: str) -> str:
    """Folder of a table's last published version; the path itself of a plain folder."""
    for entry in reversed(files.entries(spark, path)):
        if entry.folder and entry.name.startswith(_VERSION) and files.exists(spark, f"{entry.path}/{_PUBLISHED}"):
            return entry.path
    return path


def read_table(spark: SparkSession, path: str) -> DataFrame:
    """The rows of a table as it is published now, whatever is written meanwhile."""
    return spark.read.parquet(current(spark, path))


def write_table(
    df: DataFrame, path: str, by_day: bool = False, compact: bool = False, keep_seconds: float = KEEP_SECONDS
) -> None:
    """Replace a Parquet table by a new version, whole or not at all.

    ``by_day`` stores it in directories ``obs_date=...`` so that date ranges read
    only their days, and counts its rows by hour, state and city (see ``indexed_table``).
    The rows are rebalanced by day first: small days share tasks and large days are
    split, whatever their size.  ``compact`` rebalances what few rows each scan task
    kept into files of the advisory size.  Of writers that overlap the one that began
    last is read.  ``df`` may read the table itself.
    """
    spark = df.sparkSession
    began = datetime.now(timezone.utc).strftime("%Y%m%dT%H%M%S%f")
    folder = f"{path}/{_VERSION}{began}-{uuid.uuid4().hex[:8]}"
    if by_day:
        df = df.withColumn("obs_date", F.to_date("timestamp"))
        df.hint("rebalance", "obs_date").write.partitionBy("obs_date").parquet(folder)
        if not any(e.folder and not e.name.startswith("_") for e in files.entries(spark, folder)):
            # No row and so no file: one without rows has the columns.
            df.limit(0).write.mode("append").parquet(folder)
        _count_rows(spark, folder)
    else:
        (df.hint("rebalance") if compact else df).write.parquet(folder)
    files.write_text(spark, f"{folder}/{_PUBLISHED}", began)
    _drop_replaced(spark, path, keep_seconds)


def _drop_replaced(spark: SparkSession, path: str, keep_seconds: float) -> None:
    """Remove versions that were replaced long enough ago, and those of writers that died."""
    read, now = current(spark, path), time.time()
    replaced = None  # when the version after this one was published
    for entry in reversed(files.entries(spark, path)):
        if not entry.folder or not entry.name.startswith(_VERSION):
            continue
        marks = [e for e in files.entries(spark, entry.path) if e.name == _PUBLISHED]
        if marks:
            if entry.path != read and replaced is not None and now - replaced > keep_seconds:
                files.remove(spark, entry.path)
            replaced = marks[0].changed
        elif now - entry.changed > STALE_SECONDS:
            files.remove(spark, entry.path)


def _count_rows(spark: SparkSession, folder: str) -> None:
    table = spark.read.parquet(folder)
    hour = F.date_trunc("hour", "timestamp").cast(table.schema["timestamp"].dataType)
    by = [c for c in INDEXED if c in table.columns]
    table.groupBy(hour.alias("hour"), *by).agg(
        F.count(F.lit(1)).alias("rows"), F.count_if(F.col("timestamp") == hour).alias("at_start"),
    ).hint("rebalance", "hour").sortWithinPartitions("hour").write.parquet(f"{folder}/{_ROWS}")


def indexed_table(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame | None]:
    """A table and its rows by hour, state and city: hour, uf, city, rows, at_start.

    Both are of one version.  ``at_start`` are the rows timed at the hour's first moment.
    Tables that are not stored by day have no index.
    """
    folder = current(spark, path)
    rows = f"{folder}/{_ROWS}"
    return spark.read.parquet(folder), spark.read.parquet(rows) if files.exists(spark, rows) else None


@contextmanager
def parsed_once(df: DataFrame) -> Iterator[DataFrame]:
    """Keep the parsed rows of text files on executor disks while they are used.

    The statistics and the scoring each read the facts; JSON is dear to parse
    twice.  Rows of a lost executor are parsed again from the files.
    """
    kept = df.persist(StorageLevel.DISK_ONLY)
    try:
        yield kept
    finally:
        kept.unpersist()


def load_refined(spark: SparkSession, lake: Lake, name: str) -> DataFrame:
    """One refined table by name."""
    return read_table(spark, lake.refined_path(name))


def preview(df: DataFrame, columns: Sequence[str], rows: int = 10) -> DataFrame:
    """A few rows of the named columns."""
    return df.select(*columns).limit(rows)
