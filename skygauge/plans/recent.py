"""Recent-lookback jobs, run every few minutes over the last two hours."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import SparkSession

from skygauge.operators.anomalies import AIR_QUALITY, WEATHER, detect_anomalies
from skygauge.operators.refine import refine_air_quality_anomalies, refine_weather_anomalies
from skygauge.session import scratch_of
from skygauge.sources.landed import (
    LOOKBACK,
    read_cities,
    read_recent_airquality,
    read_recent_landed_weather,
    read_recent_weather_files,
    since_cutoff,
)
from skygauge.sources.tables import Lake, parsed_once, read_table, write_table


def detect_recent_weather(
    spark: SparkSession,
    lake: Lake,
    as_of: datetime,
    lookback: int = LOOKBACK,
    landed_by_stream: bool = False,
    **options,
) -> bool:
    """Write anomalies among the weather ingested since ``as_of - lookback``.

    Without recent input nothing is written and an earlier result stays; returns
    whether anything was written.  ``as_of`` is in the session's time zone (UTC).
    """
    read = read_recent_landed_weather if landed_by_stream else read_recent_weather_files
    raw = lake.raw_path("weather_recent_anomalies")
    recent = read(spark, lake.raw_path("weather"), as_of, lookback)
    with scratch_of(spark, lake.job("recent-weather")), parsed_once(recent) as recent:
        if recent.isEmpty():
            return False
        write_table(detect_anomalies(recent, WEATHER, **options), raw, compact=True)
    refined = refine_weather_anomalies(
        read_table(spark, raw), read_cities(spark, lake.cities)
    )
    write_table(refined, lake.refined_path("weather_recent_anomalies"))
    return True


def detect_recent_air_quality(
    spark: SparkSession,
    lake: Lake,
    as_of: datetime,
    lookback: int = LOOKBACK,
    **options,
) -> None:
    """Write anomalies among the measurements timed since ``as_of - lookback``."""
    recent = since_cutoff(
        read_recent_airquality(spark, lake.raw_path("airquality"), as_of, lookback),
        as_of, lookback,
    )
    with scratch_of(spark, lake.job("recent-airquality")):
        refined = refine_air_quality_anomalies(
            detect_anomalies(recent, AIR_QUALITY, **options), read_cities(spark, lake.cities)
        )
        write_table(refined, lake.refined_path("airquality_recent_anomalies"))
