"""Full-history jobs: anomaly detection and refinement of both facts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import SparkSession

from skygauge.operators.anomalies import AIR_QUALITY, WEATHER, detect_anomalies
from skygauge.operators.refine import (
    refine_air_quality,
    refine_air_quality_anomalies,
    refine_weather,
    refine_weather_anomalies,
)
from skygauge.session import scratch_of
from skygauge.sources.landed import observations, read_airquality, read_cities, rejects, weather_lines
from skygauge.sources.tables import Lake, parsed_once, read_table, write_table


def detect_weather(spark: SparkSession, lake: Lake, **options) -> None:
    """Write raw and refined weather anomalies of the whole history.

    ``options`` go to the anomaly kernel.  The refined table is made from the
    stored anomalies, so the history is scored once.  Lines that are no observations
    are stored aside, with their files.
    """
    raw = lake.raw_path("weather_anomalies")
    landed_lines = weather_lines(spark, lake.raw_path("weather"))
    with scratch_of(spark, lake.job("detect-weather")), parsed_once(landed_lines) as lines:
        write_table(detect_anomalies(observations(lines), WEATHER, **options), raw, compact=True)
        write_table(rejects(lines), lake.raw_path("weather_unreadable_lines"), compact=True)
    refined = refine_weather_anomalies(
        read_table(spark, raw), read_cities(spark, lake.cities)
    )
    write_table(refined, lake.refined_path("weather_anomalies"))


def detect_air_quality(spark: SparkSession, lake: Lake, **options) -> None:
    """Write raw and refined air-quality anomalies of the whole history."""
    raw = lake.raw_path("airquality_anomalies")
    history = read_airquality(spark, lake.raw_path("airquality"))
    with scratch_of(spark, lake.job("detect-airquality")):
        write_table(detect_anomalies(history, AIR_QUALITY, **options), raw, compact=True)
    refined = refine_air_quality_anomalies(
        read_table(spark, raw), read_cities(spark, lake.cities)
    )
    write_table(refined, lake.refined_path("airquality_anomalies"))


#: The facts that are refined.
FACTS = ("weather", "airquality")


def refine_facts(
    spark: SparkSession, lake: Lake, facts: Sequence[str] = FACTS, by_day: bool = True
) -> None:
    """Write facts with coordinates, state and typed time, once each row.

    Day directories let date ranges read their days only; with ``by_day=False`` the
    tables are flat and have no ``obs_date``.  Weather lines that are no observations
    are stored aside, with their files.
    """
    cities = read_cities(spark, lake.cities)
    if "weather" in facts:
        with parsed_once(weather_lines(spark, lake.raw_path("weather"))) as lines:
            write_table(refine_weather(observations(lines), cities), lake.refined_path("weather"), by_day)
            write_table(rejects(lines), lake.raw_path("weather_unreadable_lines"), compact=True)
    if "airquality" in facts:
        refined = refine_air_quality(read_airquality(spark, lake.raw_path("airquality")), cities)
        write_table(refined, lake.refined_path("airquality"), by_day)
