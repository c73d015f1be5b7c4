"""Refinement: coordinates, city keys, number cleanup, deduplication."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from skygauge.functions.text import city_part, uf_part
from skygauge.functions.times import event_time

# Scores that read 0 instead of NULL after cleanup.
ZERO_WHEN_MISSING = ["std_value", "aqi_z_score"]


def add_coordinates(df: DataFrame, cities: DataFrame) -> DataFrame:
    """Left join with the city dimension; an unknown city keeps NULL lat, long.

    The dimension is file-backed, so the optimizer broadcasts it by its known size
    and shuffles instead where it has outgrown the session's threshold.
    """
    return df.join(cities, "city", "left")


def split_city_key(df: DataFrame, keep_tail: bool = False) -> DataFrame:
    """Replace the ``UF-Name`` key by the name and add the state ``uf``."""
    key = F.col("city")
    return df.withColumns({"uf": uf_part(key), "city": city_part(key, keep_tail)})


def finite_or_null(x: Column) -> Column:
    """The number, or NULL for NaN and the infinities."""
    return F.when(F.abs(x) < F.lit(float("inf")), x)


def clean_numbers(df: DataFrame, zero_filled: Sequence[str] = ZERO_WHEN_MISSING) -> DataFrame:
    """NaN and infinities to NULL in every float column, then named NULLs to 0."""
    cleaned = {
        f.name: finite_or_null(F.col(f.name))
        for f in df.schema.fields
        if isinstance(f.dataType, (T.DoubleType, T.FloatType))
    }
    for name in zero_filled:
        if name in df.columns:
            cleaned[name] = F.coalesce(cleaned.get(name, F.col(name)), F.lit(0.0))
    return df.withColumns(cleaned) if cleaned else df


def time_to_timestamp(df: DataFrame) -> DataFrame:
    """Parse ``time`` and carry it as ``timestamp`` only."""
    return df.withColumn("time", event_time(F.col("time"))).withColumnRenamed(
        "time", "timestamp"
    )


def distinct_rows(df: DataFrame) -> DataFrame:
    """One of each set of equal rows; copies are combined before the shuffle."""
    return df.dropDuplicates()


def refine_weather(df: DataFrame, cities: DataFrame, keep_tail: bool = False) -> DataFrame:
    """Weather observations with coordinates, state and a typed time."""
    return distinct_rows(time_to_timestamp(split_city_key(add_coordinates(df, cities), keep_tail)))


def refine_air_quality(df: DataFrame, cities: DataFrame, keep_tail: bool = False) -> DataFrame:
    """Air-quality measurements with coordinates and state."""
    return distinct_rows(split_city_key(add_coordinates(df, cities), keep_tail))


def refine_weather_anomalies(df: DataFrame, cities: DataFrame, keep_tail: bool = False) -> DataFrame:
    """Weather anomalies with coordinates and state; the hour stays."""
    return distinct_rows(split_city_key(add_coordinates(df, cities), keep_tail))


def refine_air_quality_anomalies(
    df: DataFrame, cities: DataFrame, keep_tail: bool = False
) -> DataFrame:
    """Air-quality anomalies with coordinates and state, without the hour."""
    located = add_coordinates(df, cities).drop("hour")
    return distinct_rows(split_city_key(clean_numbers(located), keep_tail))
