"""Readings, payloads and cities derived from the given tables.

``events`` stands for the fact stream: its type is the parameter, its user picks
one of the cities made from ``nation`` and ``region``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skygauge import files
from skygauge.functions.times import partition_dates
from skygauge.operators.anomalies import AIR_QUALITY, Readings
from skygauge.operators.refine import refine_air_quality, refine_weather
from skygauge.session import scratch_path
from skygauge.sources.tables import Lake

#: Cities of the air-quality readings, and of the sparser weather.
AIR_CITIES, WEATHER_CITIES = 5, 25

#: Four of the five event types are scored.
PARAMETERS = ("click", "error", "purchase", "view")

EVENT_READINGS = Readings(
    value=AIR_QUALITY.value, keys=AIR_QUALITY.keys, time=AIR_QUALITY.time,
    mean=AIR_QUALITY.mean, spread=AIR_QUALITY.spread, score=AIR_QUALITY.score,
    parameters=PARAMETERS,
)

#: Pollutant that each event type stands for in the stored lake; the last is
#: reported but not scored.
POLLUTANTS = {"click": "pm25", "error": "pm10", "purchase": "no2", "view": "o3", "signup": "dew"}

STAMP = "yyyy-MM-dd HH:mm:ss.SSSSSS"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def city_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``UF-Name`` key of each nation."""
    nations = table(spark, sf_dir, "nation")
    regions = table(spark, sf_dir, "region")
    return nations.join(regions, nations.n_regionkey == regions.r_regionkey).select(
        "n_nationkey", F.concat_ws("-", "r_name", "n_name").alias("city")
    )


def cities(spark: SparkSession, sf_dir: str) -> DataFrame:
    """City dimension; nation 3 is missing from it."""
    key = F.col("n_nationkey")
    return city_keys(spark, sf_dir).filter(key != 3).select(
        "city", (key * 1.5 - 20).alias("lat"), (key * -0.5 - 40).alias("long")
    )


def _events_with_city(spark: SparkSession, sf_dir: str, n_cities: int) -> DataFrame:
    events = table(spark, sf_dir, "events").withColumn(
        "n_nationkey", F.pmod("user_id", F.lit(n_cities)).cast("int")
    )
    # nation and region have 25 and 5 rows at every scale.
    return events.join(F.broadcast(city_keys(spark, sf_dir)), "n_nationkey")


def air_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Air-quality measurements, with the event that each comes from."""
    return _events_with_city(spark, sf_dir, AIR_CITIES).select(
        "event_id", "city", F.col("event_type").alias("parameter"), "value",
        F.lit("AQI").alias("unit"), F.col("ts").alias("timestamp"),
        F.lit("WAQI").alias("source"),
    )


def weather(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Weather observations, time as ISO text."""
    return _events_with_city(spark, sf_dir, WEATHER_CITIES).select(
        "event_id", "city", F.date_format("ts", STAMP).alias("time"),
        F.lit(900).alias("interval"),
        F.when(F.hour("ts").between(6, 17), 1).otherwise(0).alias("is_day"),
        F.col("value").alias("temperature"),
        F.pmod("event_id", F.lit(100)).cast("int").alias("weathercode"),
        F.pmod("user_id", F.lit(360)).cast("int").alias("winddirection"),
        (F.pmod("user_id", F.lit(40)) / 2).alias("windspeed"),
    )


def gappy(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Measurements with NULL and NaN among the values."""
    return table(spark, sf_dir, "events").select(
        "event_id",
        F.when(F.pmod("user_id", F.lit(7)) == 0, None)
        .when(F.pmod("user_id", F.lit(11)) == 0, F.lit(float("nan")))
        .otherwise(F.col("value")).alias("value"),
    )


def air_quality_responses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One raw response per event as JSON text; every ninth user's has failed.

    It reports the event's own parameter and ``k``, which has no reading for
    every fifth event.
    """
    events = air_quality(spark, sf_dir).join(
        table(spark, sf_dir, "events").select("event_id", "user_id", "props"), "event_id"
    )
    k = F.when(F.pmod("event_id", F.lit(5)) == 0, F.lit("{}")).otherwise(
        F.replace(F.col("props"), F.lit('"k"'), F.lit('"v"'))
    )
    status = F.when(F.pmod("user_id", F.lit(9)) == 0, "error").otherwise("ok")
    return events.select("event_id", F.format_string(
        '{"status":"%s","data":{"iaqi":{"%s":{"v":%s},"k":%s},"time":{"s":"%s"}},"city":"%s"}',
        status, "parameter", F.col("value").cast("string"), k,
        F.date_format("timestamp", "yyyy-MM-dd HH:mm:ss"), "city",
    ).alias("value"))


def weather_responses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One raw weather response per event as JSON text."""
    inner = ["time", "interval", "temperature", "windspeed", "winddirection",
             "is_day", "weathercode"]
    return weather(spark, sf_dir).select("event_id", F.to_json(F.struct(
        F.struct(*inner).alias("current_weather"), "city"
    )).alias("value"))


def refined_air_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return refine_air_quality(air_quality(spark, sf_dir), cities(spark, sf_dir))


def refined_weather(spark: SparkSession, sf_dir: str) -> DataFrame:
    return refine_weather(weather(spark, sf_dir), cities(spark, sf_dir))


def city_file(spark: SparkSession, sf_dir: str, path: str) -> None:
    """The city dimension, 24 rows at every scale, as one JSON object."""
    entry = F.struct("city", F.struct("lat", F.col("long").alias("lon")).alias("at"))
    cities(spark, sf_dir).agg(
        F.to_json(F.map_from_entries(F.collect_list(entry))).alias("value")
    ).write.text(path)


def named_weather(spark: SparkSession, sf_dir: str, root: str | None = None) -> str:
    """Weather as collectors land it: a folder for each city, files named by their time.

    A file holds a city's observations of one day and is named by the day's noon.
    """
    root = root or scratch_path(spark, "named")
    lines = weather(spark, sf_dir).drop("event_id")
    noon = F.concat(F.date_format(F.to_timestamp("time"), "yyyyMMdd"), F.lit("-120000"))
    lines.select(F.col("city").alias("_city"), noon.alias("_noon"), F.to_json(F.struct("*")).alias("value")).repartition(
        "_city").write.partitionBy("_city", "_noon").text(f"{root}/_written")
    for file in files.files_below(spark, f"{root}/_written"):
        if file.name.startswith("part-"):
            *_, city, day, _ = file.path.split("/")
            files.move(spark, file.path, f"{root}/{city.removeprefix('_city=')}/{day.removeprefix('_noon=')}.json")
    files.remove(spark, f"{root}/_written")
    return root


def lake(spark: SparkSession, sf_dir: str, *facts: str) -> Lake:
    """A stored lake of the named facts in the landed layouts."""
    home = scratch_path(spark, "lake")
    stored = Lake(raw=f"{home}/raw", refined=f"{home}/refined", cities=f"{home}/cities")
    city_file(spark, sf_dir, stored.cities)
    if "airquality" in facts:
        pollutant = F.coalesce(*[
            F.when(F.col("parameter") == kind, name) for kind, name in POLLUTANTS.items()
        ])
        dated = partition_dates(F.col("timestamp"))
        air_quality(spark, sf_dir).drop("event_id").withColumns(
            {"parameter": pollutant, **dated}
        ).write.partitionBy(*dated).parquet(stored.raw_path("airquality"))
    if "weather" in facts:
        arrived = F.to_timestamp("time")
        weather(spark, sf_dir).drop("event_id").withColumns(
            {"ingest_ts": arrived, "ingest_date": F.to_date(arrived)}
        ).write.partitionBy("ingest_date").json(stored.raw_path("weather"))
    return stored
