"""The six serving queries: filter, order by time, page, project."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from skygauge.operators.contracts import (
    AIR_QUALITY_ANOMALY_CONTRACT,
    AIR_QUALITY_CONTRACT,
    WEATHER_ANOMALY_CONTRACT,
    WEATHER_CONTRACT,
    Contract,
    project,
)
from skygauge.operators.paging import date_range, days_of_page, hours_of_page, page, place
from skygauge.operators.refine import clean_numbers
from skygauge.sources.tables import Lake, indexed_table, load_refined

# Fixed value: rows of a page.
PAGE_ROWS = 1000


def serve(
    table: DataFrame,
    contract: Contract,
    limit: int = PAGE_ROWS,
    offset: int = 0,
    date_from: str = "",
    date_to: str = "",
    uf: str = "",
    city: str = "",
    cleaned: bool = False,
    index: DataFrame | None = None,
) -> DataFrame:
    """One page of a refined table under a contract.

    Filters come first and reach the scan, only contract columns are read, and of
    a table stored by day only the days that hold the page.  With its ``index`` these
    are the hours that hold it, found without reading the table.
    """
    rows = place(date_range(table, date_from, date_to), uf, city)
    if index is None:
        rows, offset = days_of_page(rows, limit, offset)
    else:
        rows, offset = hours_of_page(rows, index, limit, offset, date_from, date_to, uf, city)
    rows = project(rows, contract)
    if cleaned:
        rows = clean_numbers(rows)
    return page(rows, limit, offset)


def query_weather(spark: SparkSession, lake: Lake, limit: int = PAGE_ROWS, offset: int = 0,
                  date_from: str = "", date_to: str = "", uf: str = "", city: str = "") -> DataFrame:
    """Weather observations."""
    table, index = indexed_table(spark, lake.refined_path("weather"))
    return serve(table, WEATHER_CONTRACT, limit, offset, date_from, date_to, uf, city, index=index)


def query_weather_anomalies(
        spark: SparkSession, lake: Lake, limit: int = PAGE_ROWS, offset: int = 0,
        date_from: str = "", date_to: str = "", uf: str = "", city: str = "") -> DataFrame:
    """Weather anomalies of the whole history."""
    return serve(load_refined(spark, lake, "weather_anomalies"), WEATHER_ANOMALY_CONTRACT,
                 limit, offset, date_from, date_to, uf, city)


def query_recent_weather_anomalies(
        spark: SparkSession, lake: Lake, limit: int = PAGE_ROWS, offset: int = 0,
        uf: str = "", city: str = "") -> DataFrame:
    """Weather anomalies of the last recent run."""
    return serve(load_refined(spark, lake, "weather_recent_anomalies"),
                 WEATHER_ANOMALY_CONTRACT, limit, offset, uf=uf, city=city)


def query_air_quality(
        spark: SparkSession, lake: Lake, limit: int = PAGE_ROWS, offset: int = 0,
        date_from: str = "", date_to: str = "", uf: str = "", city: str = "") -> DataFrame:
    """Air-quality measurements."""
    table, index = indexed_table(spark, lake.refined_path("airquality"))
    return serve(table, AIR_QUALITY_CONTRACT, limit, offset, date_from, date_to, uf, city, index=index)


def query_air_quality_anomalies(
        spark: SparkSession, lake: Lake, limit: int = PAGE_ROWS, offset: int = 0,
        date_from: str = "", date_to: str = "", uf: str = "", city: str = "") -> DataFrame:
    """Air-quality anomalies of the whole history, numbers cleaned."""
    return serve(load_refined(spark, lake, "airquality_anomalies"),
                 AIR_QUALITY_ANOMALY_CONTRACT,
                 limit, offset, date_from, date_to, uf, city, cleaned=True)


def query_recent_air_quality_anomalies(
        spark: SparkSession, lake: Lake, limit: int = PAGE_ROWS, offset: int = 0,
        uf: str = "", city: str = "") -> DataFrame:
    """Air-quality anomalies of the last recent run, numbers cleaned."""
    return serve(load_refined(spark, lake, "airquality_recent_anomalies"),
                 AIR_QUALITY_ANOMALY_CONTRACT, limit, offset, uf=uf, city=city, cleaned=True)
