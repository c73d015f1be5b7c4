"""SQL equivalents of the registered queries, over the same tables.

A mean of 32 two-decimal readings ends in a half of the sixth place.  Computed
numbers are moved off it before rounding, here and in the registry, so that the
order of a sum cannot decide the last digit.
"""

from __future__ import annotations

STAMP = "'%Y-%m-%d %H:%M:%S.%f'"

# --- shared parts ------------------------------------------------------------

CITY_KEYS = """
city_keys AS (
  SELECT n_nationkey, r_name || '-' || n_name AS city
  FROM nation JOIN region ON n_regionkey = r_regionkey),
cities AS (
  SELECT city, n_nationkey * 1.5 - 20 AS lat, n_nationkey * -0.5 - 40 AS long
  FROM city_keys WHERE n_nationkey <> 3)"""

AIR = CITY_KEYS + """,
air AS (
  SELECT event_id, city, event_type AS parameter, value, 'AQI' AS unit, ts AS timestamp,
         'WAQI' AS source
  FROM events JOIN city_keys ON n_nationkey = user_id % 5)"""

WEATHER = CITY_KEYS + f""",
weather AS (
  SELECT event_id, city, strftime(ts, {STAMP}) AS time, 900 AS interval,
         CASE WHEN date_part('hour', ts) BETWEEN 6 AND 17 THEN 1 ELSE 0 END AS is_day,
         value AS temperature, event_id % 100 AS weathercode, user_id % 360 AS winddirection,
         (user_id % 40) / 2.0 AS windspeed, ts AS timestamp
  FROM events JOIN city_keys ON n_nationkey = user_id % 25)"""


def scored(source: str, value: str, keys: list[str], where: str = "true") -> str:
    """CTEs that score ``source`` by hour of day and interquartile range."""
    k = ", ".join(keys)
    return f""",
facts AS (SELECT *, date_part('hour', timestamp) AS hr FROM {source} WHERE {where}),
stats AS (
  SELECT {k}, hr, avg({value}) AS mean, stddev_samp({value}) AS sd FROM facts GROUP BY {k}, hr),
quarts AS (
  SELECT {k}, quantile_disc({value}, 0.25) AS q1, quantile_disc({value}, 0.75) AS q3
  FROM facts GROUP BY {k}),
scored AS (
  SELECT *, q3 - q1 AS iqr,
         abs(({value} - mean) / nullif(sd, 0)) AS z,
         {value} < q1 - 1.5 * (q3 - q1) OR {value} > q3 + 1.5 * (q3 - q1) AS flag
  FROM facts JOIN stats USING ({k}, hr) JOIN quarts USING ({k})),
levelled AS (
  SELECT *, CASE WHEN z > 3 THEN 'extrema' WHEN z > 2.5 THEN 'severa'
                 WHEN z > 2 THEN 'moderada' END AS anomaly_level FROM scored),
found AS (SELECT * FROM levelled WHERE z > 2 OR flag)"""


SCORED_TYPES = "parameter IN ('click', 'error', 'purchase', 'view')"
AIR_KEYS = ["city", "parameter"]
SINCE = "timestamp >= TIMESTAMP '2024-01-20 12:00:00'"


def air_scored(where: str = "true") -> str:
    return "WITH" + AIR + scored("air", "value", AIR_KEYS, f"{SCORED_TYPES} AND {where}")


def weather_scored(where: str = "true") -> str:
    return "WITH" + WEATHER + scored("weather", "temperature", ["city"], where)


def stamp(column: str) -> str:
    return f"strftime({column}, {STAMP})"


PLACE = "upper(split_part(city, '-', 1)) AS uf, split_part(city, '-', 2) AS city"
COORDS = "round(lat, 6) AS lat, round(long, 6) AS long"

AIR_ANOMALIES = f"""
SELECT event_id, {PLACE}, parameter, round(value, 6) AS value, unit,
       {stamp('timestamp')} AS timestamp, source,
       round(mean + 1e-9, 6) AS avg_value, round(coalesce(sd, 0) + 1e-9, 6) AS std_value,
       round(coalesce(z, 0) + 1e-9, 6) AS aqi_z_score, anomaly_level,
       round(q1, 6) AS "Q1", round(q3, 6) AS "Q3", round(iqr, 6) AS "IQR",
       flag AS is_iqr_anomaly, {COORDS}
FROM found LEFT JOIN cities USING (city)"""

WEATHER_ANOMALIES = f"""
SELECT event_id, {PLACE}, time, interval, is_day, round(temperature, 6) AS temperature,
       weathercode, winddirection, round(windspeed, 6) AS windspeed,
       {stamp('timestamp')} AS timestamp, hr AS hour,
       round(mean + 1e-9, 6) AS avg_temp, round(sd + 1e-9, 6) AS std_temp, round(z + 1e-9, 6) AS temp_z_score,
       anomaly_level, round(q1, 6) AS "Q1", round(q3, 6) AS "Q3", round(iqr, 6) AS "IQR",
       flag AS is_iqr_anomaly, {COORDS}
FROM found LEFT JOIN cities USING (city)"""

REFINED_AIR = f"""
SELECT event_id, {PLACE}, parameter, round(value, 6) AS value, unit,
       {stamp('timestamp')} AS timestamp, source, {COORDS}
FROM air LEFT JOIN cities USING (city)"""

REFINED_WEATHER = f"""
SELECT event_id, {PLACE}, {stamp('timestamp')} AS timestamp, interval, is_day,
       round(temperature, 6) AS temperature, weathercode, winddirection,
       round(windspeed, 6) AS windspeed, {COORDS}
FROM weather LEFT JOIN cities USING (city)"""

SERVED_AIR = "uf, city, timestamp, parameter, value, unit, source, lat, long"
SERVED_WEATHER = ("uf, city, timestamp, interval, is_day, temperature, weathercode, "
                  "winddirection, windspeed, lat, long")
SERVED_AIR_ANOMALY = ('uf, city, timestamp, parameter, value, unit, avg_value, std_value, '
                      'aqi_z_score, anomaly_level, "Q1", "Q3", "IQR", is_iqr_anomaly, lat, long')
SERVED_WEATHER_ANOMALY = ("uf, city, timestamp, temperature, avg_temp, temp_z_score, "
                          "anomaly_level, is_iqr_anomaly, lat, long")

GAPPY = """
WITH gappy AS (
  SELECT event_id, CASE WHEN user_id % 7 = 0 THEN NULL
                        WHEN user_id % 11 = 0 THEN 'NaN'::DOUBLE ELSE value END AS value
  FROM events),
numbers AS (SELECT * FROM gappy WHERE value IS NOT NULL AND NOT isnan(value))"""

MIXED = """
WITH mixed AS (
  SELECT 'events' AS origin, props AS value FROM events
  UNION ALL SELECT 'documents', text FROM documents)"""

WRITTEN = """
WITH written AS (
  SELECT o_orderkey, o_orderdate, o_orderkey % 6 AS kind FROM orders)"""


def windows(source: str, keys: str) -> str:
    """Two-hour windows every fifteen minutes over ``source``."""
    return f"""
placed AS (
  SELECT {keys}, value,
         time_bucket(INTERVAL 15 MINUTE, timestamp) - i * INTERVAL 15 MINUTE AS since
  FROM {source}, range(8) AS r(i)),
closed AS (
  SELECT {keys}, since, since + INTERVAL 2 HOUR AS until,
         round(avg(value) + 1e-9, 6) AS avg_value,
         round(stddev_samp(value) + 1e-9, 6) AS std_value, count(value) AS readings
  FROM placed GROUP BY {keys}, since)"""


POLLUTANT = """CASE event_type WHEN 'click' THEN 'pm25' WHEN 'error' THEN 'pm10'
         WHEN 'purchase' THEN 'no2' WHEN 'view' THEN 'o3' ELSE 'dew' END"""
LAKE_AIR = AIR.replace("event_type AS parameter", POLLUTANT + " AS parameter")


def lake_air_scored(where: str = "true") -> str:
    return "WITH" + LAKE_AIR + scored(
        "air", "value", AIR_KEYS, f"parameter IN ('pm25', 'pm10', 'no2', 'o3') AND {where}")


LAKE_AIR_ANOMALIES = AIR_ANOMALIES.replace("SELECT event_id,", "SELECT")
LAKE_WEATHER_ANOMALIES = WEATHER_ANOMALIES.replace("SELECT event_id,", "SELECT")

#: Files are named by the noon of their day; the lookback of ten days begins at noon, too.
SINCE_FILE = "timestamp >= TIMESTAMP '2024-01-20 00:00:00'"
RECENT_FILES = f"WITH {WEATHER}" + f"""
SELECT city, time, interval, is_day, round(temperature, 6) AS temperature, weathercode, winddirection,
       round(windspeed, 6) AS windspeed
FROM weather WHERE {SINCE_FILE}"""

LANDED_AIR = f"""user_id::VARCHAR AS city, event_type AS parameter, round(value, 6) AS value,
       'AQI' AS unit, {stamp('ts')} AS timestamp, 'WAQI' AS source"""


EXPECTED_SQL = {
    # statistics and scores
    "hourly_stats": air_scored() + """
SELECT city, parameter, hr AS hour, round(mean + 1e-9, 6) AS avg_value, round(sd + 1e-9, 6) AS std_value
FROM stats""",
    "quartile_stats": air_scored() + """
SELECT city, parameter, round(q1, 6) AS "Q1", round(q3, 6) AS "Q3" FROM quarts""",
    "quartile_stats_sketch": air_scored() + """
SELECT city, parameter, round(q1, 6) AS "Q1", round(q3, 6) AS "Q3" FROM quarts""",
    "quartile_stats_refined": air_scored() + """
SELECT city, parameter, round(q1, 6) AS "Q1", round(q3, 6) AS "Q3" FROM quarts""",
    "quartile_stats_approximate": air_scored() + """
SELECT city, parameter, round(q1, 6) AS "Q1", round(q3, 6) AS "Q3" FROM quarts""",
    "baseline_of_sketches": air_scored() + """
SELECT city, parameter, hr AS hour, round(mean + 1e-9, 6) AS avg_value, round(sd + 1e-9, 6) AS std_value,
       round(q1, 6) AS "Q1", round(q3, 6) AS "Q3"
FROM stats JOIN quarts USING (city, parameter)""",
    "refined_global_quantiles": """
SELECT round(quantile_disc(l_extendedprice, 0.05), 6) AS q05,
       round(quantile_disc(l_extendedprice, 0.5), 6) AS q50,
       round(quantile_disc(l_extendedprice, 0.95), 6) AS q95
FROM lineitem""",
    "global_quantiles": """
SELECT round(quantile_disc(l_extendedprice, 0.05), 6) AS q05,
       round(quantile_disc(l_extendedprice, 0.5), 6) AS q50,
       round(quantile_disc(l_extendedprice, 0.95), 6) AS q95
FROM lineitem""",
    "global_quantiles_approximate": """
SELECT share::DOUBLE AS share, true AS within_error FROM unnest([0.05, 0.5, 0.95]) AS t(share)
WHERE EXISTS (SELECT 1 FROM lineitem WHERE l_extendedprice IS NOT NULL)""",
    "trim_reference": GAPPY + """
SELECT event_id, round(value, 6) AS value FROM numbers
WHERE value BETWEEN (SELECT min(value) FROM numbers) AND (SELECT max(value) FROM numbers)""",
    "trim_exact": GAPPY + """
SELECT event_id, round(value, 6) AS value FROM numbers
WHERE value BETWEEN (SELECT quantile_disc(value, 0.05) FROM numbers)
                AND (SELECT quantile_disc(value, 0.95) FROM numbers)""",
    "pollutant_filter": f"WITH {AIR} SELECT event_id, parameter FROM air WHERE {SCORED_TYPES}",
    "zscore_severity": air_scored() + """
SELECT event_id, round(z + 1e-9, 6) AS aqi_z_score, anomaly_level FROM levelled""",
    "iqr_flags": air_scored() + """
SELECT event_id, round(q1, 6) AS "Q1", round(q3, 6) AS "Q3", round(iqr, 6) AS "IQR",
       flag AS is_iqr_anomaly FROM scored""",
    # jobs
    "anomalies_airquality": air_scored() + AIR_ANOMALIES,
    "anomalies_weather": weather_scored() + WEATHER_ANOMALIES,
    "anomalies_dedup_first": air_scored() + """
SELECT event_id, round(z + 1e-9, 6) AS aqi_z_score, anomaly_level, flag AS is_iqr_anomaly
FROM found""",
    "anomalies_drop_nonfinite": air_scored("event_id % 50 <> 0 AND event_id % 51 <> 0") + """
SELECT event_id, round(z + 1e-9, 6) AS aqi_z_score, anomaly_level, flag AS is_iqr_anomaly
FROM found""",
    "recent_anomalies": air_scored(SINCE) + AIR_ANOMALIES,
    "recent_anomalies_weather": weather_scored(SINCE) + WEATHER_ANOMALIES,
    "recency_filter": f"""
SELECT event_id, {stamp('ts')} AS timestamp FROM events
WHERE ts >= TIMESTAMP '2024-01-30 10:00:00'""",
    # refinement
    "city_coords_left_join": f"WITH {WEATHER}" + f"""
SELECT event_id, city, {COORDS} FROM weather LEFT JOIN cities USING (city)""",
    "uf_city_split": """
SELECT o_orderkey,
       upper(split_part(lower(o_orderpriority), '-', 1)) AS uf,
       split_part(lower(o_orderpriority), '-', 2) AS city,
       split_part(lower(o_orderpriority), '-', 2) || '-' || o_orderstatus AS whole_city,
       NULL::VARCHAR AS no_city
FROM orders""",
    "invalid_number_cleanup": """
SELECT event_id,
       CASE WHEN user_id % 3 <> 0 THEN round(value, 6) END AS value,
       CASE WHEN user_id % 4 = 0 THEN 0 ELSE round(value, 6) END AS std_value,
       CASE WHEN user_id % 5 <= 1 THEN 0 ELSE round(value, 6) END AS aqi_z_score
FROM events""",
    "refine_dedup": f"WITH {AIR}" + f"""
SELECT DISTINCT {PLACE}, parameter, round(round(value / 10) * 10, 6) AS value, unit,
       {stamp("date_trunc('day', timestamp)::TIMESTAMP")} AS timestamp, source, {COORDS}
FROM air LEFT JOIN cities USING (city)""",
    "refined_airquality": f"WITH {AIR}" + REFINED_AIR,
    "refined_weather": f"WITH {WEATHER}" + REFINED_WEATHER,
    "letter_range_cities": """
SELECT doc_id FROM documents
WHERE (lang = 'en' AND upper(text[1]) BETWEEN 'A' AND 'H')
   OR (lang = 'fr' AND upper(text[1]) BETWEEN 'D' AND 'P')
   OR (lang = 'de' AND upper(text[1]) BETWEEN 'C' AND 'Z')""",
    "city_file_coordinates": f"WITH {AIR}" + f"""
SELECT event_id, city, {COORDS} FROM air LEFT JOIN cities USING (city)""",
    # payloads and scalars
    "payload_explode": f"WITH {AIR}" + """,
reported AS (
  SELECT city, strftime(timestamp, '%Y-%m-%d %H:%M:%S') AS timestamp, parameter, value,
         event_id, user_id, props
  FROM air JOIN (SELECT event_id, user_id, props FROM events) USING (event_id)
  WHERE user_id % 9 <> 0)
SELECT city, timestamp, parameter, round(value, 6) AS value, 'AQI' AS unit, 'WAQI' AS source
FROM reported
UNION ALL
SELECT city, timestamp, 'k',
       CASE WHEN event_id % 5 <> 0
            THEN regexp_extract(props, '[0-9]+')::DOUBLE END, 'AQI', 'WAQI'
FROM reported""",
    "payload_flatten": f"WITH {WEATHER}" + """
SELECT city, time, interval, round(temperature, 6) AS temperature,
       round(windspeed, 6) AS windspeed, winddirection, is_day, weathercode FROM weather""",
    "message_decode": """
SELECT 'events' AS origin, regexp_extract(props, '[0-9]+')::BIGINT AS k, count(*) AS n
FROM events GROUP BY ALL""",
    "message_unreadable": "SELECT text AS value FROM documents",
    "message_encode": f"WITH {AIR}" + """
SELECT '{"event_id":' || event_id || ',"city":"' || city || '","parameter":"' || parameter
       || '","value":' || CASE WHEN event_id % 3 = 0 THEN 'null' ELSE value::VARCHAR END
       || '}' AS value
FROM air""",
    "json_validity": MIXED + """
SELECT origin, value, json_valid(value) AS valid FROM mixed""",
    "slugify_documents": """
SELECT doc_id, trim(regexp_replace(regexp_replace(
         translate(lower(text), ' àáâãäåèéêëìíîïòóôõöùúûüñç', '-aaaaaaeeeeiiiiooooouuuunc'),
         '[^a-z0-9-]+', '', 'g'), '-{2,}', '-', 'g'), '-') AS slug
FROM documents""",
    "url_encoding": """
SELECT origin, id, replace(replace(url_encode(raw), '%2F', '/'), '%7E', '~') AS encoded
FROM (SELECT 'pages' AS origin, page_id AS id, url AS raw FROM pages
      UNION ALL SELECT 'documents', doc_id, text FROM documents)""",
    "day_bounds": WRITTEN + f"""
SELECT o_orderkey,
       CASE WHEN kind <= 3 THEN {stamp("date_trunc('day', o_orderdate)::TIMESTAMP")} END AS bound
FROM written""",
    "event_times": WRITTEN + f"""
SELECT o_orderkey,
       CASE kind WHEN 0 THEN {stamp("date_trunc('day', o_orderdate)::TIMESTAMP")}
                 WHEN 1 THEN strftime(o_orderdate, '%Y-%m-%d 15:30:00.000000') END AS parsed
FROM written""",
    "landing_times": WRITTEN + f"""
SELECT o_orderkey,
       CASE kind WHEN 0 THEN {stamp("date_trunc('day', o_orderdate)::TIMESTAMP")}
                 WHEN 1 THEN strftime(o_orderdate, '%Y-%m-%d 15:30:00.000000')
                 WHEN 2 THEN CASE WHEN day(o_orderdate) <= 12
                                  THEN strftime(o_orderdate, '%Y-%d-%m 00:00:00.000000')
                                  ELSE strftime(o_orderdate, '%Y-%m-%d 00:00:00.000000') END
                 WHEN 3 THEN strftime(o_orderdate, '%Y-%m-%d 00:00:00.000000')
                 ELSE '2025-01-01 00:00:00.000000' END AS landed
FROM written""",
    "date_partitions": """
SELECT l_orderkey, l_linenumber, date_part('year', l_shipdate) AS year,
       strftime(l_shipdate, '%m') AS month, strftime(l_shipdate, '%d') AS day
FROM lineitem""",
    "date_texts": """
SELECT event_id, strftime(ts, '%Y-%m-%dT00:00:00') AS iso, strftime(ts, '%d-%m-%Y') AS display,
       strftime(ts, '%Y-%m-%d') AS iso_date, strftime(ts, '%d-%m-%Y') AS time_text
FROM events""",
    "file_name_times": f"""
SELECT event_id,
       CASE WHEN event_id % 10 <> 0
            THEN {stamp("date_trunc('second', ts)::TIMESTAMP")} END AS ingested
FROM events""",
    # contracts and serving
    "contract_violations": """
SELECT event_id, concat_ws('; ',
         CASE WHEN event_id % 13 = 0 THEN 'city missing' END,
         CASE WHEN event_id % 7 = 0 THEN 'unit not allowed' END,
         CASE WHEN event_id % 11 = 0 THEN 'source not allowed' END) AS violations
FROM events WHERE event_id % 13 = 0 OR event_id % 7 = 0 OR event_id % 11 = 0""",
    "contract_valid": weather_scored() + """
SELECT event_id, anomaly_level FROM found WHERE event_id % 5 <> 0""",
    "serve_page": f"WITH {AIR}, refined AS ({REFINED_AIR})" + f"""
SELECT {SERVED_AIR} FROM refined ORDER BY timestamp, {SERVED_AIR} LIMIT 1000 OFFSET 500""",
    "serve_deep_page": f"WITH {WEATHER}, refined AS ({REFINED_WEATHER})" + f"""
SELECT {SERVED_WEATHER} FROM refined ORDER BY timestamp, {SERVED_WEATHER}
LIMIT 700 OFFSET 4000""",
    "serve_ranked_page": f"WITH {WEATHER}, refined AS ({REFINED_WEATHER})" + f"""
SELECT {SERVED_WEATHER} FROM refined ORDER BY timestamp, {SERVED_WEATHER}
LIMIT 700 OFFSET 4000""",
    "serve_date_range": f"WITH {WEATHER}, refined AS ({REFINED_WEATHER})" + f"""
SELECT {SERVED_WEATHER} FROM refined
WHERE timestamp BETWEEN '2024-01-05 00:00:00.000000' AND '2024-01-08 00:00:00.000000'
ORDER BY timestamp, {SERVED_WEATHER} LIMIT 1000""",
    "serve_uf_city": f"WITH {AIR}, refined AS ({REFINED_AIR})" + f"""
SELECT {SERVED_AIR} FROM refined WHERE uf = 'ASIA' AND city = 'NATION_2'
ORDER BY timestamp, {SERVED_AIR} LIMIT 1000""",
    "serve_airquality_anomalies": air_scored() + f", refined AS ({AIR_ANOMALIES})" + f"""
SELECT {SERVED_AIR_ANOMALY} FROM refined WHERE timestamp >= '2024-01-03 00:00:00.000000'
ORDER BY timestamp, {SERVED_AIR_ANOMALY} LIMIT 300 OFFSET 10""",
    "serve_weather_anomalies": weather_scored() + f", refined AS ({WEATHER_ANOMALIES})" + f"""
SELECT {SERVED_WEATHER_ANOMALY} FROM refined WHERE uf = 'EUROPE'
ORDER BY timestamp, {SERVED_WEATHER_ANOMALY} LIMIT 300""",
    "preview_rows": f"WITH {AIR}" + f"""
SELECT event_id, {stamp('timestamp')} AS timestamp, city, parameter, round(value, 6) AS value
FROM air ORDER BY air.timestamp, event_id LIMIT 10""",
    # stored jobs
    "job_batch_airquality": lake_air_scored() + LAKE_AIR_ANOMALIES,
    "job_batch_weather": weather_scored() + LAKE_WEATHER_ANOMALIES,
    "job_batch_then_query_airquality": (
        "WITH" + LAKE_AIR + """,
known AS (SELECT * FROM air WHERE parameter IN ('pm25', 'pm10', 'no2', 'o3')),
band AS (
  SELECT * FROM known
  WHERE value BETWEEN (SELECT quantile_disc(value, 0.05) FROM known)
                  AND (SELECT quantile_disc(value, 0.95) FROM known))"""
        + scored("band", "value", AIR_KEYS) + f", refined AS ({LAKE_AIR_ANOMALIES})" + f"""
SELECT {SERVED_AIR_ANOMALY} FROM refined WHERE timestamp <= '2024-01-25 00:00:00.000000'
ORDER BY timestamp, {SERVED_AIR_ANOMALY} LIMIT 200 OFFSET 5"""),
    "job_batch_then_query_weather": (
        weather_scored() + f", refined AS ({LAKE_WEATHER_ANOMALIES})" + f"""
SELECT {SERVED_WEATHER_ANOMALY} FROM refined
WHERE uf = 'AFRICA' AND timestamp >= '2024-01-10 00:00:00.000000'
ORDER BY timestamp, {SERVED_WEATHER_ANOMALY} LIMIT 200"""),
    "job_recent_airquality": lake_air_scored(SINCE) + f", refined AS ({LAKE_AIR_ANOMALIES})" + f"""
SELECT {SERVED_AIR_ANOMALY} FROM refined WHERE uf = 'ASIA'
ORDER BY timestamp, {SERVED_AIR_ANOMALY} LIMIT 1000""",
    "job_recent_weather": weather_scored(SINCE) + f", refined AS ({LAKE_WEATHER_ANOMALIES})" + f"""
SELECT {SERVED_WEATHER_ANOMALY} FROM refined
ORDER BY timestamp, {SERVED_WEATHER_ANOMALY} LIMIT 50""",
    "job_refine_then_page": f"WITH {WEATHER}, refined AS ({REFINED_WEATHER})" + f"""
SELECT {SERVED_WEATHER} FROM refined ORDER BY timestamp, {SERVED_WEATHER}
LIMIT 800 OFFSET 3000""",
    "job_refine_then_range": f"WITH {LAKE_AIR}, refined AS ({REFINED_AIR})" + f"""
SELECT {SERVED_AIR} FROM refined
WHERE uf = 'EUROPE'
  AND timestamp BETWEEN '2024-01-10 00:00:00.000000' AND '2024-01-20 00:00:00.000000'
ORDER BY timestamp, {SERVED_AIR} LIMIT 1000""",
    "job_refine_then_range_page": f"WITH {LAKE_AIR}, refined AS ({REFINED_AIR})" + f"""
SELECT {SERVED_AIR} FROM refined
WHERE uf = 'ASIA'
  AND timestamp BETWEEN '2024-01-03 00:00:00.000000' AND '2024-01-25 00:00:00.000000'
ORDER BY timestamp, {SERVED_AIR} LIMIT 150 OFFSET 60""",
    "recent_weather_files": RECENT_FILES,
    "recent_weather_filed": RECENT_FILES,
    "job_recent_weather_files": weather_scored(SINCE_FILE) + f", refined AS ({LAKE_WEATHER_ANOMALIES})" + f"""
SELECT {SERVED_WEATHER_ANOMALY} FROM refined
ORDER BY timestamp, {SERVED_WEATHER_ANOMALY} LIMIT 50""",
    "job_rejected_weather": f"WITH {WEATHER}" + """
SELECT city, time, winddirection + 0.5 AS winddirection FROM weather WHERE winddirection % 7 = 0""",
    # streams
    "stream_airquality_landing": f"""
SELECT {LANDED_AIR} FROM events WHERE event_id % 10 <> 0 AND event_id % 11 <> 0""",
    "stream_unreadable_airquality": """
SELECT CASE WHEN event_id % 10 = 0 THEN '{"event_id": ' || event_id
            ELSE '{"city": "a", "value": "v' || event_id || '"}' END AS value
FROM events WHERE event_id % 10 = 0 OR event_id % 11 = 0""",
    "stream_recent_airquality": f"""
SELECT {LANDED_AIR} FROM events
WHERE event_id % 10 <> 0 AND event_id % 11 <> 0
  AND ts >= TIMESTAMP '2024-01-28' AND ts < TIMESTAMP '2024-01-31'""",
    "stream_weather_landing": f"""
SELECT 'UF-' || (user_id % 5) AS city, {stamp('ts')} AS time, 900 AS interval, event_id % 2 AS is_day,
       round(value, 6) AS temperature, event_id % 100 AS weathercode, user_id % 360 AS winddirection,
       round((user_id % 40) / 2.0, 6) AS windspeed
FROM events""",
    "stream_sliding_stats": f"""
WITH readings AS (
  SELECT event_type AS parameter, 'all' AS city, value, ts AS timestamp FROM events),
{windows('readings', 'city, parameter')}
SELECT city, parameter, {stamp('since')} AS since, {stamp('until')} AS until,
       avg_value, std_value, readings
FROM closed WHERE until <= (SELECT max(timestamp) FROM readings) - INTERVAL 2 HOUR""",
    "sliding_window_stats": f"WITH {AIR}, {windows('air', 'city, parameter')}" + f"""
SELECT city, parameter, {stamp('since')} AS since, {stamp('until')} AS until,
       avg_value, std_value, readings
FROM closed""",
    "stream_redelivery": "SELECT event_id, round(value, 6) AS value FROM events",
    "stream_redelivery_in_parts": "SELECT event_id, round(value, 6) AS value FROM events",
    "stream_recent_refresh": lake_air_scored(SINCE) + f", refined AS ({LAKE_AIR_ANOMALIES})" + f"""
SELECT {SERVED_AIR_ANOMALY} FROM refined WHERE city = 'NATION_1'
ORDER BY timestamp, {SERVED_AIR_ANOMALY} LIMIT 1000""",
}
