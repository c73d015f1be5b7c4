"""Upkeep jobs of landed files: filing by ingestion date, compaction of closed days."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import SparkSession

from skygauge.sources.compaction import FILE_BYTES, compact_days
from skygauge.sources.landed import file_weather_by_date
from skygauge.sources.tables import Lake
from skygauge.streaming import ingest

#: A day is closed when so long a time has passed since its end.
GRACE = timedelta(days=1)


def file_weather(spark: SparkSession, lake: Lake, as_of: datetime | None = None) -> int:
    """File the weather that collectors put into a folder for each city by ingestion date."""
    return file_weather_by_date(spark, lake.raw_path("weather"))


def compact_air_quality(spark: SparkSession, lake: Lake, as_of: datetime, file_bytes: int = FILE_BYTES) -> int:
    """Compact the air-quality days that are closed at ``as_of``; how many were."""
    return _compact(spark, lake.raw_path("airquality"), ingest.AIR_QUALITY, as_of, file_bytes)


def compact_weather(
    spark: SparkSession, lake: Lake, as_of: datetime, file_bytes: int = FILE_BYTES, by_city: bool = True
) -> int:
    """Compact the weather landed by streams on days that are closed at ``as_of``; how many folders were."""
    kind = ingest.WEATHER if by_city else ingest.WEATHER_BY_DATE
    return _compact(spark, lake.raw_path("weather"), kind, as_of, file_bytes)


def _compact(spark, root, kind, as_of, file_bytes):
    return compact_days(spark, root, kind.folders, kind.form, (as_of - GRACE).date(),
                        ingest.pending_batches(spark, root), file_bytes)
