"""Landed raw files: air-quality Parquet by day, weather JSON by city."""

from __future__ import annotations

import re
from datetime import datetime, timedelta
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from skygauge import files, schemas
from skygauge.functions.payloads import decode_json, readable
from skygauge.functions.times import event_time, file_name_time

# Fixed value: how far the recent jobs look back, in seconds.
LOOKBACK = 7200

#: Weather as streams land it: they also say when it was ingested.
LANDED_WEATHER = T.StructType([*schemas.WEATHER.fields, T.StructField("ingest_ts", T.TimestampType())])


def _airquality_files(spark: SparkSession, root: str) -> DataFrame:
    """Landed Parquet with its date columns.  The stored types are asked for, since
    collectors may have stored whole-number values as integers."""
    try:
        return spark.read.parquet(root)
    except AnalysisException as error:
        if error.getCondition() != "UNABLE_TO_INFER_SCHEMA":
            raise
        return spark.read.schema(_AIRQUALITY_LAYOUT).parquet(root)


_AIRQUALITY_LAYOUT = T.StructType([
    *schemas.AIR_QUALITY.fields,
    *[T.StructField(part, T.IntegerType()) for part in ("year", "month", "day")],
])


def read_airquality(spark: SparkSession, root: str) -> DataFrame:
    """Every landed measurement; the date directories are not columns."""
    return schemas.conform(_airquality_files(spark, root), schemas.AIR_QUALITY)


def read_recent_airquality(
    spark: SparkSession, root: str, as_of: datetime, lookback: int = LOOKBACK
) -> DataFrame:
    """Measurements of the day directories that the lookback touches.

    The condition is on partition columns only, so other days are not read; a
    day without a directory contributes nothing.
    """
    first, last = (as_of - timedelta(seconds=lookback)).date(), as_of.date()
    days = [first + timedelta(days=n) for n in range((last - first).days + 1)]
    any_day = reduce(Column.__or__, [
        (F.col("year") == d.year) & (F.col("month") == d.month) & (F.col("day") == d.day)
        for d in days
    ])
    return schemas.conform(
        _airquality_files(spark, root).filter(any_day), schemas.AIR_QUALITY
    )


def since_cutoff(
    df: DataFrame, as_of: datetime, lookback: int = LOOKBACK, column: str = "timestamp"
) -> DataFrame:
    """Event times from ``as_of - lookback`` on, in whole seconds, no upper bound.

    Comparing the stored column with a literal of its own type equals comparing
    floored seconds, and reaches the Parquet reader.
    """
    cutoff = as_of.replace(microsecond=0) - timedelta(seconds=lookback)
    kind, when = df.schema[column].dataType, F.col(column)
    if isinstance(kind, T.StringType):
        kind, when = T.TimestampType(), event_time(when)
    return df.filter(when >= F.lit(str(cutoff)).cast(kind))


def weather_lines(spark: SparkSession, root: str) -> DataFrame:
    """Every landed line with its fields and ``file``, in directories by city or as streams land them.

    A line that is no observation has its text in ``_unreadable``: no JSON object, a field
    of another type, or a fraction where a whole number belongs.  Each line is parsed
    once, so it is readable for every query or for none.
    """
    lines = spark.read.option("recursiveFileLookup", "true").text(root)
    return _decoded(lines.select("value", F.col("_metadata.file_path").alias("file")), schemas.WEATHER)


def _decoded(lines: DataFrame, schema: T.StructType) -> DataFrame:
    return decode_json(lines.filter(F.trim("value") != ""), "value", schema, alone=False)


def observations(lines: DataFrame) -> DataFrame:
    """The observations among ``weather_lines``."""
    return schemas.conform(readable(lines), schemas.WEATHER)


def rejects(lines: DataFrame) -> DataFrame:
    """file, line of what is no observation among ``weather_lines``."""
    return lines.filter(F.col("_unreadable").isNotNull()).select("file", F.col("_unreadable").alias("line"))


def read_weather(spark: SparkSession, root: str) -> DataFrame:
    """Every landed observation."""
    return observations(weather_lines(spark, root))


def rejected_weather(spark: SparkSession, root: str) -> DataFrame:
    """The landed lines that the reads leave out, with their file."""
    return rejects(weather_lines(spark, root))


#: Folder of the files that were ingested on a day.
_FILED = "ingest_date="
_FILE_NAME = re.compile(r"(\d{4})(\d{2})(\d{2})-\d{6}\.json")


def recent_folders(spark: SparkSession, root: str, cutoff: datetime) -> list[str]:
    """Folders below ``root`` that may hold files ingested since ``cutoff``.

    These are the days from the cutoff's on, and what is not filed by day yet.
    """
    return [
        e.path for e in files.entries(spark, root)
        if e.folder and not e.name.startswith(("_", "."))
        and (not e.name.startswith(_FILED) or e.name.removeprefix(_FILED) >= str(cutoff.date()))
    ]


def file_weather_by_date(spark: SparkSession, root: str) -> int:
    """Move landed files from their city's folder to one of their ingestion date; how many were moved.

    The day and time are those that the file's name carries.  Each file is moved by
    itself and keeps its name, so a run that breaks off leaves every file in one place,
    and the next run moves the rest; files of another name stay.  A run lists the
    cities' folders, which hold only what came since the last one.
    """
    moved = 0
    for city in files.entries(spark, root):
        if not city.folder or city.name.startswith(("_", ".")) or "=" in city.name:
            continue
        for file in files.entries(spark, city.path):
            named = _FILE_NAME.fullmatch(file.name)
            if named and not file.folder:
                day = "-".join(named.groups())
                files.move(spark, file.path, f"{root}/{_FILED}{day}/city_key={city.name}/{file.name}")
                moved += 1
    return moved


def read_recent_weather_files(
    spark: SparkSession, root: str, as_of: datetime, lookback: int = LOOKBACK
) -> DataFrame:
    """Observations of files whose name time is at or after the cutoff.

    Only folders of the lookback's days are listed (see ``file_weather_by_date``), and
    those of cities whose files are not filed by day yet.  The condition on the name is
    one on file metadata, so older files of these folders are listed but not opened.
    """
    moment = as_of - timedelta(seconds=lookback)
    folders = recent_folders(spark, root, moment)
    if not folders:
        return spark.createDataFrame([], schemas.WEATHER)
    cutoff = F.lit(str(moment)).cast("timestamp")
    lines = spark.read.option("recursiveFileLookup", "true").text(folders).filter(
        file_name_time(F.col("_metadata.file_path")) >= cutoff)
    return observations(_decoded(lines, schemas.WEATHER))


def read_recent_landed_weather(
    spark: SparkSession, root: str, as_of: datetime, lookback: int = LOOKBACK
) -> DataFrame:
    """The same for the stream's layout: by ingestion date, then ingestion time."""
    cutoff = as_of - timedelta(seconds=lookback)
    lines = spark.read.text(root).filter(F.col("ingest_date") >= F.lit(str(cutoff.date())).cast("date"))
    recent = _decoded(lines.select("value"), LANDED_WEATHER)
    return observations(recent.filter(F.col("ingest_ts") >= F.lit(str(cutoff)).cast("timestamp")))


def read_cities(spark: SparkSession, path: str) -> DataFrame:
    """City dimension from a JSON object of coordinates by city.

    A file that is no such object, or an empty one, fails the query that reads it; a file
    of no bytes is skipped by the reader and gives no city.
    Of a city that is listed again the last entry counts.
    """
    found = F.from_json("value", schemas.CITY_FILE, {"mode": "FAILFAST"})
    cities = F.when(F.size(found) > 0, found).otherwise(
        F.raise_error(F.lit("the city file holds no city")))
    return (
        spark.read.text(path, wholetext=True)
        .select(F.posexplode(cities).alias("_pos", "city", "_at"))
        .groupBy("city").agg(F.max_by("_at", "_pos").alias("_at"))
        .select("city", F.col("_at.lat").alias("lat"), F.col("_at.lon").alias("long"))
    )
