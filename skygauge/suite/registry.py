"""The registered queries.  Integers leave as BIGINT, times as text, doubles
rounded to six places (moved off exact halves first), so that two engines can be
compared."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from skygauge import functions as sf
from skygauge import schemas
from skygauge.functions import payloads
from skygauge.operators import anomalies, cities, contracts, paging, quantiles, refine
from skygauge.operators.anomalies import WEATHER
from skygauge.plans import batch, recent, serving, upkeep
from skygauge.session import scratch_path
from skygauge.sources import compaction, landed, tables
from skygauge.streaming import ingest, refresh
from skygauge.suite import inputs
from skygauge.suite.inputs import EVENT_READINGS, STAMP, table

Query = Callable[[SparkSession, str], DataFrame]

#: Reference moment of the recent queries, with a lookback wide enough to hold
#: groups of several readings.
AS_OF, RECENT = datetime(2024, 1, 30, 12, 0, 0), 10 * 86400

QUERIES: dict[str, Query] = {}


def query(build: Query) -> Query:
    QUERIES[build.__name__] = build
    return build


def plain(df: DataFrame) -> DataFrame:
    """Types that every engine writes alike."""
    columns = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            c = F.round(c.cast("double") + 1e-9, 6)
        elif isinstance(f.dataType, T.IntegralType):
            c = c.cast("long")
        elif isinstance(f.dataType, (T.TimestampType, T.TimestampNTZType)):
            c = F.date_format(c, STAMP)
        elif isinstance(f.dataType, T.DateType):
            c = c.cast("string")
        columns.append(c.alias(f.name))
    return df.select(*columns)


# --- statistics and scores -------------------------------------------------

def _prepared(spark, sf_dir):
    return anomalies.prepare(inputs.air_quality(spark, sf_dir), EVENT_READINGS)


def _scored(spark, sf_dir):
    facts = _prepared(spark, sf_dir)
    return anomalies.score(facts, anomalies.baseline(facts, EVENT_READINGS), EVENT_READINGS)


@query
def hourly_stats(spark, sf_dir):
    return plain(anomalies.hourly_stats(_prepared(spark, sf_dir), EVENT_READINGS))


@query
def quartile_stats(spark, sf_dir):
    return plain(quantiles.quartiles(_prepared(spark, sf_dir), EVENT_READINGS.keys, "value"))


@query
def quartile_stats_sketch(spark, sf_dir):
    return plain(quantiles.quartiles(
        _prepared(spark, sf_dir), EVENT_READINGS.keys, "value", method="sketch"))


@query
def quartile_stats_refined(spark, sf_dir):
    return plain(quantiles.quartiles(
        _prepared(spark, sf_dir), EVENT_READINGS.keys, "value", method="refine"))


@query
def quartile_stats_approximate(spark, sf_dir):
    return plain(quantiles.quartiles(
        _prepared(spark, sf_dir), EVENT_READINGS.keys, "value", method="approximate"))


@query
def baseline_of_sketches(spark, sf_dir):
    """Hourly moments and quartiles by one grouped pass."""
    return plain(anomalies.baseline(_prepared(spark, sf_dir), EVENT_READINGS, "sketch").table)


@query
def refined_global_quantiles(spark, sf_dir):
    shares = {"q05": 0.05, "q50": 0.5, "q95": 0.95}
    return plain(quantiles.METHODS["refine"](
        table(spark, sf_dir, "lineitem"), [], "l_extendedprice", shares))


@query
def global_quantiles(spark, sf_dir):
    shares = {"q05": 0.05, "q50": 0.5, "q95": 0.95}
    return plain(quantiles.exact_quantiles(
        table(spark, sf_dir, "lineitem"), [], "l_extendedprice", shares))


@query
def global_quantiles_approximate(spark, sf_dir):
    """Quantiles within a rank error of 1 %: how many there are, and whether each keeps to it."""
    shares, error = [0.05, 0.5, 0.95], 0.01
    prices = table(spark, sf_dir, "lineitem")
    found = quantiles.global_quantiles(prices, "l_extendedprice", shares, error)
    spans = quantiles.rank_shares(prices, "l_extendedprice", found)
    wanted = spark.createDataFrame(list(zip(found, shares)), "value double, share double")
    near = (F.col("below") <= F.col("share") + error) & (F.col("up_to") >= F.col("share") - error)
    return spans.join(F.broadcast(wanted), "value").select("share", near.alias("within_error"))


@query
def trim_reference(spark, sf_dir):
    return plain(quantiles.trim_band(inputs.gappy(spark, sf_dir), "value"))


@query
def trim_exact(spark, sf_dir):
    return plain(quantiles.trim_band(inputs.gappy(spark, sf_dir), "value", relative_error=0.0))


@query
def pollutant_filter(spark, sf_dir):
    return plain(anomalies.pollutant_filter(
        inputs.air_quality(spark, sf_dir), inputs.PARAMETERS).select("event_id", "parameter"))


@query
def zscore_severity(spark, sf_dir):
    return plain(_scored(spark, sf_dir).select("event_id", "aqi_z_score", "anomaly_level"))


@query
def iqr_flags(spark, sf_dir):
    return plain(_scored(spark, sf_dir).select("event_id", "Q1", "Q3", "IQR", "is_iqr_anomaly"))


# --- jobs --------------------------------------------------------------------

@query
def anomalies_airquality(spark, sf_dir):
    found = anomalies.detect_anomalies(inputs.air_quality(spark, sf_dir), EVENT_READINGS)
    return plain(refine.refine_air_quality_anomalies(found, inputs.cities(spark, sf_dir)))


@query
def anomalies_weather(spark, sf_dir):
    found = anomalies.detect_anomalies(inputs.weather(spark, sf_dir), WEATHER)
    return plain(refine.refine_weather_anomalies(found, inputs.cities(spark, sf_dir)))


@query
def anomalies_dedup_first(spark, sf_dir):
    doubled = inputs.air_quality(spark, sf_dir)
    doubled = doubled.unionByName(doubled)
    found = anomalies.detect_anomalies(doubled, EVENT_READINGS, dedup_first=True)
    return plain(found.select("event_id", "aqi_z_score", "anomaly_level", "is_iqr_anomaly"))


@query
def anomalies_drop_nonfinite(spark, sf_dir):
    spoiled = inputs.air_quality(spark, sf_dir).withColumn(
        "value", F.when(F.pmod("event_id", F.lit(50)) == 0, F.lit(float("inf")))
        .when(F.pmod("event_id", F.lit(51)) == 0, F.lit(float("nan"))).otherwise(F.col("value")))
    found = anomalies.detect_anomalies(spoiled, EVENT_READINGS, drop_nonfinite=True)
    return plain(found.select("event_id", "aqi_z_score", "anomaly_level", "is_iqr_anomaly"))


@query
def recent_anomalies(spark, sf_dir):
    recent = landed.since_cutoff(inputs.air_quality(spark, sf_dir), AS_OF, RECENT)
    found = anomalies.detect_anomalies(recent, EVENT_READINGS)
    return plain(refine.refine_air_quality_anomalies(found, inputs.cities(spark, sf_dir)))


@query
def recent_anomalies_weather(spark, sf_dir):
    recent = landed.since_cutoff(inputs.weather(spark, sf_dir), AS_OF, RECENT, "time")
    found = anomalies.detect_anomalies(recent, WEATHER)
    return plain(refine.refine_weather_anomalies(found, inputs.cities(spark, sf_dir)))


@query
def recency_filter(spark, sf_dir):
    recent = landed.since_cutoff(inputs.air_quality(spark, sf_dir), AS_OF, landed.LOOKBACK)
    return plain(recent.select("event_id", "timestamp"))


# --- refinement --------------------------------------------------------------

@query
def city_coords_left_join(spark, sf_dir):
    located = refine.add_coordinates(
        inputs.weather(spark, sf_dir), inputs.cities(spark, sf_dir))
    return plain(located.select("event_id", "city", "lat", "long"))


@query
def uf_city_split(spark, sf_dir):
    key = F.concat_ws("-", F.lower("o_orderpriority"), "o_orderstatus")
    return plain(table(spark, sf_dir, "orders").select(
        "o_orderkey",
        sf.uf_part(key).alias("uf"), sf.city_part(key).alias("city"),
        sf.city_part(key, keep_tail=True).alias("whole_city"),
        sf.city_part(F.col("o_orderstatus")).alias("no_city"),
    ))


@query
def invalid_number_cleanup(spark, sf_dir):
    user, value = F.col("user_id"), F.col("value")
    spoiled = table(spark, sf_dir, "events").select(
        "event_id",
        F.when(F.pmod(user, F.lit(3)) == 0, F.lit(float("inf"))).otherwise(value).alias("value"),
        F.when(F.pmod(user, F.lit(4)) == 0, F.lit(float("nan"))).otherwise(value).alias("std_value"),
        F.when(F.pmod(user, F.lit(5)) == 0, F.lit(float("-inf")))
        .when(F.pmod(user, F.lit(5)) == 1, None).otherwise(value).alias("aqi_z_score"),
    )
    return plain(refine.clean_numbers(spoiled))


@query
def refine_dedup(spark, sf_dir):
    coarse = inputs.air_quality(spark, sf_dir).select(
        "city", "parameter", F.round("value", -1).alias("value"), "unit",
        F.date_trunc("day", "timestamp").cast("timestamp_ntz").alias("timestamp"), "source")
    return plain(refine.refine_air_quality(coarse, inputs.cities(spark, sf_dir)))


@query
def refined_airquality(spark, sf_dir):
    return plain(inputs.refined_air_quality(spark, sf_dir))


@query
def refined_weather(spark, sf_dir):
    return plain(inputs.refined_weather(spark, sf_dir))


@query
def letter_range_cities(spark, sf_dir):
    keyed = table(spark, sf_dir, "documents").select(
        "doc_id", F.concat_ws("-", F.upper("lang"), "text").alias("city"))
    chosen = cities.cities_in_ranges(keyed, "EN{A-H},bad,FR{D-P},DE{A-B},DE{C-Z},ES{Z-A}")
    return plain(chosen.select("doc_id"))


@query
def city_file_coordinates(spark, sf_dir):
    """Every event located by the city dimension read from its JSON file."""
    path = scratch_path(spark, "cities")
    inputs.city_file(spark, sf_dir, path)
    located = refine.add_coordinates(
        inputs.air_quality(spark, sf_dir), landed.read_cities(spark, path))
    return plain(located.select("event_id", "city", "lat", "long"))


# --- payloads and scalars ------------------------------------------------------

@query
def payload_explode(spark, sf_dir):
    decoded = payloads.readable(payloads.decode_json(
        inputs.air_quality_responses(spark, sf_dir), "value", schemas.AIR_QUALITY_PAYLOAD))
    return plain(payloads.explode_pollutants(decoded))


@query
def payload_flatten(spark, sf_dir):
    decoded = payloads.readable(payloads.decode_json(
        inputs.weather_responses(spark, sf_dir), "value", schemas.WEATHER_PAYLOAD))
    return plain(payloads.flatten_weather(decoded))


def _mixed_messages(spark, sf_dir):
    """JSON from events among documents, which are not JSON."""
    notes = table(spark, sf_dir, "documents").select(
        F.lit("documents").alias("origin"), F.col("text").alias("value"))
    props = table(spark, sf_dir, "events").select(
        F.lit("events").alias("origin"), F.col("props").alias("value"))
    return props.unionByName(notes)


@query
def message_decode(spark, sf_dir):
    schema = T.StructType([T.StructField("k", T.IntegerType())])
    decoded = payloads.decode_json(_mixed_messages(spark, sf_dir), "value", schema)
    return plain(payloads.readable(decoded).groupBy("origin", "k").agg(F.count("*").alias("n")))


@query
def message_unreadable(spark, sf_dir):
    schema = T.StructType([T.StructField("k", T.IntegerType())])
    decoded = payloads.decode_json(_mixed_messages(spark, sf_dir), "value", schema)
    return plain(payloads.unreadable(decoded))


@query
def message_encode(spark, sf_dir):
    fields = inputs.air_quality(spark, sf_dir).select(
        "event_id", "city", "parameter", F.when(F.col("event_id") % 3 != 0, F.col("value")).alias("value"))
    return plain(payloads.encode_json(fields))


@query
def json_validity(spark, sf_dir):
    return plain(_mixed_messages(spark, sf_dir).select(
        "origin", "value", sf.is_json(F.col("value")).alias("valid")))


@query
def slugify_documents(spark, sf_dir):
    return plain(table(spark, sf_dir, "documents").select(
        "doc_id", sf.slugify(F.col("text")).alias("slug")))


@query
def url_encoding(spark, sf_dir):
    urls = table(spark, sf_dir, "pages").select(
        F.lit("pages").alias("origin"), F.col("page_id").alias("id"), F.col("url").alias("raw"))
    texts = table(spark, sf_dir, "documents").select(
        F.lit("documents").alias("origin"), F.col("doc_id").alias("id"), F.col("text").alias("raw"))
    return plain(urls.unionByName(texts).select(
        "origin", "id", sf.url_encode(F.col("raw")).alias("encoded")))


def _written_dates(spark, sf_dir):
    """Order dates as text in several spellings, some unreadable."""
    day, kind = F.col("o_orderdate"), F.pmod("o_orderkey", F.lit(6))
    return table(spark, sf_dir, "orders").select("o_orderkey", (
        F.when(kind == 0, F.date_format(day, "yyyy-MM-dd"))
        .when(kind == 1, F.date_format(day, "yyyy-MM-dd'T'15:30:00"))
        .when(kind == 2, F.date_format(day, "dd-MM-yyyy"))
        .when(kind == 3, F.date_format(day, "yyyyMMdd"))
        .when(kind == 4, F.lit("12:00"))
        .otherwise(F.col("o_orderpriority"))
    ).alias("written"))


@query
def day_bounds(spark, sf_dir):
    return plain(_written_dates(spark, sf_dir).select(
        "o_orderkey", sf.to_day(F.col("written")).alias("bound")))


@query
def event_times(spark, sf_dir):
    return plain(_written_dates(spark, sf_dir).select(
        "o_orderkey", sf.event_time(F.col("written")).alias("parsed")))


@query
def landing_times(spark, sf_dir):
    ingested = F.lit("2025-01-01 00:00:00").cast("timestamp")
    return plain(_written_dates(spark, sf_dir).select(
        "o_orderkey", sf.landing_time(F.col("written"), ingested).alias("landed")))


@query
def date_partitions(spark, sf_dir):
    parts = [c.alias(n) for n, c in sf.partition_dates(F.col("l_shipdate")).items()]
    return plain(table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", *parts))


@query
def date_texts(spark, sf_dir):
    when = F.col("ts")
    return plain(table(spark, sf_dir, "events").select(
        "event_id",
        sf.date_string(when).alias("iso"),
        sf.date_string(when, "display").alias("display"),
        sf.date_string(when, "iso_date_only").alias("iso_date"),
        sf.time_string(when).alias("time_text"),
    ))


@query
def file_name_times(spark, sf_dir):
    stamp = F.date_format("ts", "yyyyMMdd-HHmmss")
    path = F.when(
        F.pmod("event_id", F.lit(10)) == 0, F.concat(F.lit("weather/x/part-"), stamp)
    ).otherwise(F.concat(F.lit("weather/x/"), stamp, F.lit(".json")))
    return plain(table(spark, sf_dir, "events").select(
        "event_id", sf.file_name_time(path).alias("ingested")))


# --- contracts and serving -----------------------------------------------------

@query
def contract_violations(spark, sf_dir):
    facts = inputs.refined_air_quality(spark, sf_dir)
    every = lambda n: F.pmod("event_id", F.lit(n)) == 0
    spoiled = facts.withColumns({
        "unit": F.when(every(7), "ppm").otherwise(F.col("unit")),
        "source": F.when(every(11), "X").otherwise(F.col("source")),
        "city": F.when(every(13), None).otherwise(F.col("city")),
    })
    _, quarantined = contracts.check_contract(spoiled, contracts.AIR_QUALITY_CONTRACT)
    return plain(quarantined.select(
        "event_id", F.array_join("violations", "; ").alias("violations")))


@query
def contract_valid(spark, sf_dir):
    found = anomalies.detect_anomalies(inputs.weather(spark, sf_dir), WEATHER)
    table_ = refine.refine_weather_anomalies(found, inputs.cities(spark, sf_dir)).withColumn(
        "anomaly_level", F.when(F.pmod("event_id", F.lit(5)) == 0, "alta")
        .otherwise(F.col("anomaly_level")))
    valid, _ = contracts.check_contract(table_, contracts.WEATHER_ANOMALY_CONTRACT)
    return plain(valid.select("event_id", "anomaly_level"))


@query
def serve_page(spark, sf_dir):
    return plain(serving.serve(
        inputs.refined_air_quality(spark, sf_dir), contracts.AIR_QUALITY_CONTRACT,
        limit=1000, offset=500))


@query
def serve_deep_page(spark, sf_dir):
    """Found by the stored counts of the table's hours."""
    lake = inputs.lake(spark, sf_dir, "weather")
    batch.refine_facts(spark, lake, ["weather"])
    rows, index = tables.indexed_table(spark, lake.refined_path("weather"))
    rows, offset = paging.hours_of_page(rows, index, 700, 4000)
    return plain(paging.page(contracts.project(rows, contracts.WEATHER_CONTRACT), 700, offset))


@query
def serve_ranked_page(spark, sf_dir):
    """Found by counting the rows."""
    rows = contracts.project(
        inputs.refined_weather(spark, sf_dir), contracts.WEATHER_CONTRACT)
    return plain(paging.page(rows, limit=700, offset=4000, top_k_rows=0))


@query
def serve_date_range(spark, sf_dir):
    return plain(serving.serve(
        inputs.refined_weather(spark, sf_dir), contracts.WEATHER_CONTRACT,
        date_from="2024-01-05T15:30", date_to="08-01-2024"))


@query
def serve_uf_city(spark, sf_dir):
    return plain(serving.serve(
        inputs.refined_air_quality(spark, sf_dir), contracts.AIR_QUALITY_CONTRACT,
        uf="asia", city="Nation_2"))


@query
def serve_airquality_anomalies(spark, sf_dir):
    found = anomalies.detect_anomalies(inputs.air_quality(spark, sf_dir), EVENT_READINGS)
    refined = refine.refine_air_quality_anomalies(found, inputs.cities(spark, sf_dir))
    return plain(serving.serve(
        refined, contracts.AIR_QUALITY_ANOMALY_CONTRACT, limit=300, offset=10,
        date_from="2024-01-03", cleaned=True))


@query
def serve_weather_anomalies(spark, sf_dir):
    found = anomalies.detect_anomalies(inputs.weather(spark, sf_dir), WEATHER)
    refined = refine.refine_weather_anomalies(found, inputs.cities(spark, sf_dir))
    return plain(serving.serve(
        refined, contracts.WEATHER_ANOMALY_CONTRACT, limit=300, uf="EUROPE"))


@query
def preview_rows(spark, sf_dir):
    ordered = paging.by_time(inputs.air_quality(spark, sf_dir), ["event_id"])
    return plain(tables.preview(ordered, ["event_id", "timestamp", "city", "parameter", "value"]))


# --- stored jobs -----------------------------------------------------------------

@query
def job_batch_airquality(spark, sf_dir):
    lake = inputs.lake(spark, sf_dir, "airquality")
    batch.detect_air_quality(spark, lake)
    return plain(tables.load_refined(spark, lake, "airquality_anomalies"))


@query
def job_batch_weather(spark, sf_dir):
    lake = inputs.lake(spark, sf_dir, "weather")
    batch.detect_weather(spark, lake)
    return plain(tables.load_refined(spark, lake, "weather_anomalies"))


@query
def job_batch_then_query_airquality(spark, sf_dir):
    lake = inputs.lake(spark, sf_dir, "airquality")
    batch.detect_air_quality(spark, lake, relative_error=0.0)
    return plain(serving.query_air_quality_anomalies(
        spark, lake, limit=200, offset=5, date_to="2024-01-25"))


@query
def job_batch_then_query_weather(spark, sf_dir):
    lake = inputs.lake(spark, sf_dir, "weather")
    batch.detect_weather(spark, lake, method="sketch")
    return plain(serving.query_weather_anomalies(
        spark, lake, limit=200, date_from="2024-01-10", uf="africa"))


@query
def job_recent_airquality(spark, sf_dir):
    lake = inputs.lake(spark, sf_dir, "airquality")
    recent.detect_recent_air_quality(spark, lake, AS_OF, RECENT)
    return plain(serving.query_recent_air_quality_anomalies(spark, lake, uf="Asia"))


@query
def job_recent_weather(spark, sf_dir):
    lake = inputs.lake(spark, sf_dir, "weather")
    recent.detect_recent_weather(spark, lake, AS_OF, RECENT, landed_by_stream=True)
    return plain(serving.query_recent_weather_anomalies(spark, lake, limit=50))


@query
def job_refine_then_page(spark, sf_dir):
    lake = inputs.lake(spark, sf_dir, "weather")
    batch.refine_facts(spark, lake, ["weather"])
    return plain(serving.query_weather(spark, lake, limit=800, offset=3000))


@query
def job_refine_then_range(spark, sf_dir):
    lake = inputs.lake(spark, sf_dir, "airquality")
    batch.refine_facts(spark, lake, ["airquality"])
    return plain(serving.query_air_quality(
        spark, lake, date_from="2024-01-10", date_to="20-01-2024", uf="europe"))


@query
def job_refine_then_range_page(spark, sf_dir):
    """A page far into a range of days, by the stored counts."""
    lake = inputs.lake(spark, sf_dir, "airquality")
    batch.refine_facts(spark, lake, ["airquality"])
    return plain(serving.query_air_quality(
        spark, lake, limit=150, offset=60, date_from="2024-01-03", date_to="2024-01-25", uf="asia"))


@query
def recent_weather_files(spark, sf_dir):
    """Landed files named by their time, in a folder for each city."""
    root = inputs.named_weather(spark, sf_dir)
    return plain(landed.read_recent_weather_files(spark, root, AS_OF, RECENT))


@query
def recent_weather_filed(spark, sf_dir):
    """The same files, filed by ingestion date."""
    root = inputs.named_weather(spark, sf_dir)
    landed.file_weather_by_date(spark, root)
    return plain(landed.read_recent_weather_files(spark, root, AS_OF, RECENT))


@query
def job_recent_weather_files(spark, sf_dir):
    """The recent job over landed files, filed by ingestion date."""
    lake = inputs.lake(spark, sf_dir)
    inputs.named_weather(spark, sf_dir, lake.raw_path("weather"))
    upkeep.file_weather(spark, lake)
    recent.detect_recent_weather(spark, lake, AS_OF, RECENT)
    return plain(serving.query_recent_weather_anomalies(spark, lake, limit=50))


@query
def job_rejected_weather(spark, sf_dir):
    """The lines that a job sets aside: those of a reading with a fraction of a degree."""
    lake = inputs.lake(spark, sf_dir)
    spoiled = inputs.weather(spark, sf_dir).drop("event_id").withColumn(
        "winddirection", F.when(F.col("winddirection") % 7 == 0, F.col("winddirection") + 0.5)
        .otherwise(F.col("winddirection").cast("double")))
    payloads.encode_json(spoiled).write.text(lake.raw_path("weather"))
    batch.refine_facts(spark, lake, ["weather"])
    return plain(tables.read_table(spark, lake.raw_path("weather_unreadable_lines")).select(
        F.get_json_object("line", "$.city").alias("city"), F.get_json_object("line", "$.time").alias("time"),
        F.get_json_object("line", "$.winddirection").cast("double").alias("winddirection")))


# --- streams ---------------------------------------------------------------------

def _event_stream(spark, sf_dir):
    schema = table(spark, sf_dir, "events").schema
    return spark.readStream.schema(schema).parquet(f"{sf_dir}/events.parquet*")


ONCE = {"availableNow": True}


def _air_messages(spark, sf_dir):
    """Every event as a message; those of every tenth are cut off, of every eleventh mistyped."""
    texts = payloads.encode_json(_event_stream(spark, sf_dir).select(
        F.col("user_id").cast("string").alias("city"), F.col("event_type").alias("parameter"),
        "value", F.lit("AQI").alias("unit"), F.date_format("ts", STAMP).alias("timestamp"),
        F.lit("WAQI").alias("source"), "event_id"))
    number = F.get_json_object("value", "$.event_id").cast("long")
    return texts.select(
        F.when(number % 10 == 0, F.concat(F.lit('{"event_id": '), number))
        .when(number % 11 == 0, F.concat(F.lit('{"city": "a", "value": "v'), number, F.lit('"}')))
        .otherwise(F.col("value")).alias("value"))


def _landed(spark, messages, kind):
    home = scratch_path(spark, "landing")
    ingest.land(messages, kind, f"{home}/rows", f"{home}/rejected", f"{home}/checkpoint", ONCE).awaitTermination()
    return home


@query
def stream_airquality_landing(spark, sf_dir):
    """Messages streamed to day directories."""
    home = _landed(spark, _air_messages(spark, sf_dir), ingest.AIR_QUALITY)
    return plain(landed.read_airquality(spark, f"{home}/rows"))


@query
def stream_unreadable_airquality(spark, sf_dir):
    """The messages that the same stream sets aside."""
    home = _landed(spark, _air_messages(spark, sf_dir), ingest.AIR_QUALITY)
    return plain(ingest.read_rejected(spark, f"{home}/rejected").select("value"))


@query
def stream_recent_airquality(spark, sf_dir):
    """The days of a lookback in what was streamed, after compaction."""
    home = _landed(spark, _air_messages(spark, sf_dir), ingest.AIR_QUALITY)
    compaction.compact_days(spark, f"{home}/rows", ingest.AIR_QUALITY.folders, "parquet", AS_OF.date(), file_bytes=1 << 12)
    return plain(landed.read_recent_airquality(spark, f"{home}/rows", AS_OF, 2 * 86400))


@query
def stream_weather_landing(spark, sf_dir):
    messages = payloads.encode_json(_event_stream(spark, sf_dir).select(
        F.concat(F.lit("UF-"), F.pmod("user_id", F.lit(5))).alias("city"),
        F.date_format("ts", STAMP).alias("time"), F.lit(900).alias("interval"),
        F.pmod("event_id", F.lit(2)).alias("is_day"), F.col("value").alias("temperature"),
        F.pmod("event_id", F.lit(100)).alias("weathercode"),
        F.pmod("user_id", F.lit(360)).cast("double").alias("winddirection"),
        (F.pmod("user_id", F.lit(40)) / 2).alias("windspeed")))
    home = _landed(spark, messages, ingest.WEATHER)
    return plain(landed.read_weather(spark, f"{home}/rows"))


@query
def stream_sliding_stats(spark, sf_dir):
    """Closed sliding windows of the event stream."""
    readings = _event_stream(spark, sf_dir).select(
        F.col("event_type").alias("parameter"), F.lit("all").alias("city"), "value",
        F.col("ts").cast("timestamp").alias("timestamp"))
    home = scratch_path(spark, "windows")
    stats = refresh.sliding_stats(readings, EVENT_READINGS)
    (stats.writeStream.format("parquet").option("checkpointLocation", f"{home}/checkpoint")
     .trigger(**ONCE).start(f"{home}/stats").awaitTermination())
    return plain(spark.read.schema(stats.schema).parquet(f"{home}/stats"))


@query
def sliding_window_stats(spark, sf_dir):
    readings = inputs.air_quality(spark, sf_dir).withColumn(
        "timestamp", F.col("timestamp").cast("timestamp"))
    return plain(refresh.sliding_stats(readings, EVENT_READINGS))


@query
def stream_redelivery(spark, sf_dir):
    """Every event delivered twice; each lands once."""
    events = _event_stream(spark, sf_dir).withColumn("timestamp", F.col("ts").cast("timestamp"))
    once = refresh.drop_redelivered(events.union(events), ["event_id"])
    home = scratch_path(spark, "redelivery")
    (once.writeStream.format("parquet").option("checkpointLocation", f"{home}/checkpoint")
     .trigger(**ONCE).start(f"{home}/events").awaitTermination())
    return plain(spark.read.schema(once.schema).parquet(f"{home}/events").select("event_id", "value"))


@query
def stream_redelivery_in_parts(spark, sf_dir):
    """The same, repeats dropped within parts of the input first."""
    events = _event_stream(spark, sf_dir).withColumn("timestamp", F.col("ts").cast("timestamp"))
    once = refresh.drop_redelivered(events.union(events), ["event_id"], parts=8)
    home = scratch_path(spark, "redelivery")
    (once.writeStream.format("parquet").option("checkpointLocation", f"{home}/checkpoint")
     .trigger(**ONCE).start(f"{home}/events").awaitTermination())
    return plain(spark.read.schema(once.schema).parquet(f"{home}/events").select("event_id", "value"))


@query
def stream_recent_refresh(spark, sf_dir):
    """The recent job run by arrivals, then served."""
    lake = inputs.lake(spark, sf_dir, "airquality")
    refresh.refresh_recent(
        _event_stream(spark, sf_dir),
        lambda as_of: recent.detect_recent_air_quality(spark, lake, as_of, RECENT),
        scratch_path(spark, "refresh"), ONCE, clock=lambda: AS_OF,
    ).awaitTermination()
    return plain(serving.query_recent_air_quality_anomalies(spark, lake, city="NATION_1"))
