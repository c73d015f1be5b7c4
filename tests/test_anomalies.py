"""The anomaly kernel on literal readings, checked against plain Python."""

from __future__ import annotations

import functools
import math
import random
from datetime import datetime, timedelta
from statistics import mean, stdev

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skygauge.operators import anomalies as an
from skygauge.operators.anomalies import AIR_QUALITY, WEATHER
from tests.conftest import plan, rows

NOON = datetime(2025, 6, 8, 12, 0)
SCHEMA = "city string, parameter string, value double, unit string, timestamp timestamp_ntz, source string"


def readings(spark, values, city="SP-Campinas", parameter="pm25", start=NOON):
    data = [
        (city, parameter, None if v is None else float(v), "AQI", start + timedelta(minutes=i), "WAQI")
        for i, v in enumerate(values)
    ]
    return spark.createDataFrame(data, SCHEMA)


def brute_force(values):
    """(value, z, level, flag) of one group, by definition."""
    clean = sorted(v for v in values if v is not None and not math.isnan(v))
    m, s = mean(clean), stdev(clean) if len(clean) > 1 else None
    q1 = clean[max(math.ceil(0.25 * len(clean)), 1) - 1]
    q3 = clean[max(math.ceil(0.75 * len(clean)), 1) - 1]
    found = []
    for v in clean:
        z = abs(v - m) / s if s else None
        level = next((n for n, f in (("extrema", 3), ("severa", 2.5), ("moderada", 2))
                      if z is not None and z > f), None)
        flag = v < q1 - 1.5 * (q3 - q1) or v > q3 + 1.5 * (q3 - q1)
        if (z is not None and z > 2) or flag:
            found.append((v, None if z is None else round(z, 9), level, flag))
    return sorted(found, key=repr)


def outcome(df):
    return rows(df.select(
        "value", F.round("aqi_z_score", 9), "anomaly_level", "is_iqr_anomaly"))


SPIKE = [10.0, 11, 12, 11, 10, 12, 11, 10, 12, 11, 10, 12, 90]


@pytest.mark.parametrize("values", [
    SPIKE,
    [5.0],
    [7.5] * 6,
    [1.0, 2.0, None, float("nan"), 3.0, 50.0],
    [1.0, 1, 1, 1, 9],
])
def test_one_group_matches_definition(spark, values):
    found = an.detect_anomalies(readings(spark, values), AIR_QUALITY)
    assert outcome(found) == brute_force(values)


def test_spike_reaches_the_highest_level(spark):
    found = an.detect_anomalies(readings(spark, SPIKE), AIR_QUALITY).collect()
    assert [(r.value, r.anomaly_level, r.is_iqr_anomaly) for r in found] == [(90.0, "extrema", True)]


def test_constant_group_has_no_score_and_no_error(spark):
    facts = an.prepare(readings(spark, [7.1] * 4), AIR_QUALITY)
    scored = an.score(facts, an.baseline(facts, AIR_QUALITY), AIR_QUALITY)
    assert {(r.std_value, r.aqi_z_score, r.anomaly_level) for r in scored.collect()} == {(0.0, None, None)}


def test_single_row_group_is_kept_only_by_its_flag(spark):
    usual = readings(spark, [10.0 + i % 3 for i in range(12)])
    alone = readings(spark, [99.0], start=NOON + timedelta(hours=5))
    found = an.detect_anomalies(usual.union(alone), AIR_QUALITY).collect()
    assert [(r.value, r.std_value, r.aqi_z_score, r.is_iqr_anomaly) for r in found] == [
        (99.0, None, None, True)]


def test_hour_of_day_groups_span_days(spark):
    days = [readings(spark, [float(d % 3)], start=NOON + timedelta(days=d)) for d in range(8)]
    df = days[0]
    for d in days[1:]:
        df = df.union(d)
    stats = an.hourly_stats(an.prepare(df, AIR_QUALITY), AIR_QUALITY).collect()
    assert [(r.hour, round(r.avg_value, 6)) for r in stats] == [(12, 0.875)]


def test_rows_without_city_time_or_known_parameter_leave(spark):
    df = (
        readings(spark, [1.0, 2.0])
        .union(readings(spark, [3.0], city=None))
        .union(readings(spark, [4.0], parameter="dew"))
        .union(readings(spark, [5.0], parameter=None))
        .union(readings(spark, [6.0]).withColumn("timestamp", F.lit(None).cast("timestamp_ntz")))
    )
    assert rows(an.prepare(df, AIR_QUALITY), "value") == [(1.0,), (2.0,)]


def test_unreadable_text_time_is_dropped_not_an_error(spark):
    df = spark.createDataFrame(
        [("SP-Santos", "2025-06-08T12:00", 20.0), ("SP-Santos", "soon", 21.0)],
        "city string, time string, temperature double")
    assert rows(an.prepare(df, WEATHER), "temperature", "hour") == [(20.0, 12)]


def test_infinity_spoils_its_group_unless_dropped(spark):
    df = readings(spark, [1.0, 2.0, float("inf")])
    found = an.detect_anomalies(df, AIR_QUALITY).collect()
    assert {r.anomaly_level for r in found} == {"extrema"} and len(found) == 3
    assert all(math.isnan(r.aqi_z_score) for r in found)
    assert an.detect_anomalies(df, AIR_QUALITY, drop_nonfinite=True).count() == 0


def test_thresholds_are_strict(spark):
    from skygauge.functions.scoring import severity
    df = spark.createDataFrame([(z,) for z in (2.0, 2.1, 2.5, 2.6, 3.0, 3.1)] + [(None,)], "z double")
    assert [r[0] for r in df.select(severity(F.col("z"))).collect()] == [
        None, "moderada", "moderada", "severa", "severa", "extrema", None]


def test_fences_are_strict(spark):
    from skygauge.functions.scoring import iqr_outlier
    df = spark.createDataFrame([(v,) for v in (-5.0, -5.1, 15.0, 15.1)], "x double")
    flags = df.select(iqr_outlier(F.col("x"), F.lit(2.5), F.lit(7.5))).collect()
    assert [r[0] for r in flags] == [False, True, False, True]


def test_anomaly_filter_is_three_valued(spark):
    df = spark.createDataFrame(
        [(None, True), (None, False), (None, None), (3.0, None), (2.0, False)],
        "aqi_z_score double, is_iqr_anomaly boolean")
    kept = rows(an.only_anomalies(df, AIR_QUALITY))
    assert kept == [(3.0, None), (None, True)]


def test_empty_input_gives_empty_output(spark):
    empty = spark.createDataFrame([], SCHEMA)
    for method in ("exact", "sketch"):
        assert an.detect_anomalies(empty, AIR_QUALITY, method=method).count() == 0
    assert an.detect_anomalies(empty, AIR_QUALITY, relative_error=0.0).count() == 0


def test_repeats_weigh_unless_removed_first(spark):
    once = readings(spark, SPIKE)
    last = once.filter("value = 90")
    tripled = once.union(last).union(last)
    plain = an.detect_anomalies(tripled, AIR_QUALITY)
    assert outcome(plain) == brute_force(SPIKE + [90, 90])
    assert outcome(an.detect_anomalies(tripled, AIR_QUALITY, dedup_first=True)) == brute_force(SPIKE)


def test_sketch_equals_exact_within_its_size(spark):
    df = readings(spark, [float((i * 37) % 101) for i in range(400)] + [900.0])
    exact = an.detect_anomalies(df, AIR_QUALITY, method="exact")
    assert outcome(exact) == outcome(an.detect_anomalies(df, AIR_QUALITY, method="sketch"))


def test_unknown_method_is_refused(spark):
    with pytest.raises(KeyError):
        an.detect_anomalies(readings(spark, [1.0]), AIR_QUALITY, method="guess")


def test_shuffled_join_gives_the_same_scores(spark):
    """One city holds most rows; the lookup is treated as too large to copy."""
    hot = readings(spark, [float((i * 31) % 57) for i in range(600)])
    rare = readings(spark, [float(i % 7) for i in range(40)], city="SP-Santos")
    facts = an.prepare(hot.union(rare), AIR_QUALITY)
    lookup = an.baseline(facts, AIR_QUALITY)
    threshold = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(threshold)
    try:
        spark.conf.set(threshold, "-1")
        shuffled = an.score(facts, lookup, AIR_QUALITY, limit=0)
        assert "SortMergeJoin" in plan(shuffled)
        wide = outcome(shuffled)
    finally:
        spark.conf.set(threshold, before)
    copied = an.score(facts, lookup, AIR_QUALITY)
    assert "BroadcastHashJoin" in plan(copied)
    assert outcome(copied) == wide


def test_weather_keeps_time_timestamp_and_hour(spark):
    data = [("SP-Santos", f"2025-06-08T12:{i:02d}", float(v)) for i, v in enumerate(SPIKE)]
    df = spark.createDataFrame(data, "city string, time string, temperature double")
    found = an.detect_anomalies(df, WEATHER)
    assert {"time", "timestamp", "hour", "avg_temp", "std_temp", "temp_z_score"} <= set(found.columns)
    assert rows(found, "temperature", "anomaly_level") == [(90.0, "extrema")]


def test_window_form_gives_the_same_scores(spark):
    """The same statistics written as window functions, as a cross-check."""
    from pyspark.sql import Window
    df = readings(spark, [float((i * 13) % 29) for i in range(90)] + [300.0, 301.0])
    facts = an.prepare(df, AIR_QUALITY)
    by_hour = Window.partitionBy("city", "parameter", "hour")
    entity = Window.partitionBy("city", "parameter")
    x = F.col("value")
    z = F.abs(F.try_divide(x - F.avg(x).over(by_hour), F.stddev_samp(x).over(by_hour)))
    windowed = facts.select(
        "value", F.round(z, 6).alias("z"),
        F.expr("percentile_disc(0.25) WITHIN GROUP (ORDER BY value)").over(entity).alias("q1"))
    scored = an.score(facts, an.baseline(facts, AIR_QUALITY), AIR_QUALITY)
    assert rows(windowed) == rows(scored.select("value", F.round("aqi_z_score", 6), "Q1"))


VALUES = st.lists(
    st.one_of(st.none(), st.just(float("nan")), st.integers(-30, 30).map(float), st.just(500.0)),
    min_size=1, max_size=40)


@settings(max_examples=6, deadline=None, derandomize=True, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.dictionaries(st.sampled_from(["SP-Santos", "SP-Campinas", "RJ-Niterói"]), VALUES, min_size=1))
def test_random_groups_match_definition(spark, groups):
    """Each city by itself, whatever else is scored with it."""
    parts = [readings(spark, values, city=city) for city, values in groups.items()]
    df = functools.reduce(DataFrame.union, parts)
    found = an.detect_anomalies(df, AIR_QUALITY)
    for city, values in groups.items():
        real = [v for v in values if v is not None and not math.isnan(v)]
        assert outcome(found.filter(F.col("city") == city)) == (brute_force(values) if real else [])


def large_groups(spark):
    """Two cities of 60,000 different readings each, by hour; one reading is infinite."""
    value = F.when(F.col("id") == 7, F.lit(float("inf"))).otherwise(F.sin("id") * 50 + 1e6)
    return spark.range(0, 120_000, 1, 12).select(
        F.concat(F.lit("c"), F.col("id") % 2).alias("city"), value.alias("temperature"),
        (F.col("id") % 24).cast("int").alias("hour"))


def test_sketches_share_the_pass_of_the_moments(spark):
    facts = large_groups(spark)
    found = an.baseline(facts, WEATHER, "sketch").table
    exact = an.baseline(facts, WEATHER, "exact").table
    both = found.join(exact, ["city", "hour"]).select(
        found["avg_temp"], exact["avg_temp"], found["std_temp"], exact["std_temp"]).collect()
    assert len(both) == 24
    for mean, true_mean, spread, true_spread in both:
        if math.isinf(true_mean):
            assert math.isinf(mean) and math.isnan(spread) and math.isnan(true_spread)
        else:
            assert mean == pytest.approx(true_mean, rel=1e-12) and spread == pytest.approx(true_spread, rel=1e-9)
    for city in ("c0", "c1"):
        own = facts.filter(F.col("city") == city)
        quarts = found.filter(F.col("city") == city).select("Q1", "Q3").distinct().collect()
        assert len(quarts) == 1
        for name, share in (("Q1", 0.25), ("Q3", 0.75)):
            rank = own.filter(F.col("temperature") <= quarts[0][name]).count() / own.count()
            assert abs(rank - share) < 0.005


def test_sketched_kernel_reads_the_facts_twice(spark, tmp_path):
    path = str(tmp_path / "facts")
    spark.range(5000).select(
        F.lit("SP-A").alias("city"), F.sin("id").alias("temperature"),
        F.date_format(F.timestamp_seconds(F.col("id") * 600), "yyyy-MM-dd'T'HH:mm").alias("time")).write.parquet(path)
    reads, plain = [], an.materialize

    def noted(df, *args, **measures):
        reads.append(plan(df).count("Scan parquet"))
        return plain(df, *args, **measures)

    an.materialize, keep = noted, plain
    try:
        found = an.detect_anomalies(spark.read.parquet(path), WEATHER, method="sketch")
    finally:
        an.materialize = keep
    facts = [p for p in plan(found).splitlines() if "Location" in p and "facts" in p]
    assert len(reads) == 2 and len(facts) == 1  # once for the statistics, once for the scores


def test_copies_are_dropped_by_one_shuffle(spark):
    data = [("SP-A", "o3", float(i % 7), NOON) for i in range(50)] * 2
    df = spark.createDataFrame(data, "city string, parameter string, value double, timestamp timestamp_ntz")
    found = an.detect_anomalies(df, AIR_QUALITY, dedup_first=True)
    text = plan(found)
    assert "hashpartitioning(city" not in text or "BroadcastHashJoin" in text
    assert "HashAggregate" not in text.split("BroadcastExchange")[0]


@pytest.mark.parametrize("method", ["exact", "refine", "approximate", "sketch"])
def test_methods_agree_on_small_groups(spark, method):
    rng = random.Random(2)
    data = [(c, "o3", rng.choice([1.0, 2.0, 3.0, 50.0]), NOON + timedelta(hours=i % 3)) for c in "ab" for i in range(60)]
    df = spark.createDataFrame(data, "city string, parameter string, value double, timestamp timestamp_ntz")
    columns = ("city", "value", "timestamp", "Q1", "Q3", "anomaly_level", "is_iqr_anomaly")
    found = rows(an.detect_anomalies(df, AIR_QUALITY, method=method), *columns)
    assert found == rows(an.detect_anomalies(df, AIR_QUALITY), *columns) and found
