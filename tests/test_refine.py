"""Coordinates, keys, cleanup, deduplication, city ranges, contracts."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import functions as F

from skygauge.operators import contracts as ct
from skygauge.operators import refine
from skygauge.operators.cities import cities_in_ranges, letter_ranges
from tests.conftest import rows

NAN, INF = float("nan"), float("inf")


def city_table(spark):
    return spark.createDataFrame(
        [("SP-Santos", -23.9, -46.3), ("SP-Embu-Guaçu", -23.8, -46.8)], "city string, lat double, long double")


def test_unknown_city_keeps_null_coordinates(spark):
    df = spark.createDataFrame([("SP-Santos",), ("XX-Nowhere",), (None,)], "city string")
    found = rows(refine.add_coordinates(df, city_table(spark)), "city", "lat")
    assert found == sorted([("SP-Santos", -23.9), ("XX-Nowhere", None), (None, None)], key=repr)


def test_state_comes_from_the_whole_key(spark):
    df = spark.createDataFrame([("sp-Embu-Guaçu",), ("NoHyphen",)], "city string")
    assert rows(refine.split_city_key(df), "uf", "city") == [("NOHYPHEN", None), ("SP", "Embu")]
    assert ("SP", "Embu-Guaçu") in rows(refine.split_city_key(df, keep_tail=True), "uf", "city")


def test_cleanup_of_numbers(spark):
    df = spark.createDataFrame(
        [(1, NAN, None, INF, "x"), (2, -INF, 2.0, None, "y"), (3, 1.5, NAN, 3.0, "z")],
        "i int, value double, std_value double, aqi_z_score double, s string")
    assert rows(refine.clean_numbers(df)) == [
        (1, None, 0.0, 0.0, "x"), (2, None, 2.0, 0.0, "y"), (3, 1.5, 0.0, 3.0, "z")]


def test_dedup_is_idempotent_and_null_safe(spark):
    df = spark.createDataFrame([(1, None), (1, None), (2, "a"), (2, "a"), (2, "b")], "i int, s string")
    once = refine.distinct_rows(df)
    assert rows(once) == rows(refine.distinct_rows(once)) == [(1, None), (2, "a"), (2, "b")]


def test_refined_weather_has_typed_timestamp(spark):
    df = spark.createDataFrame(
        [("SP-Santos", "2025-06-08T12:00", 20.0), ("SP-Santos", "2025-06-08T12:00", 20.0),
         ("SP-Santos", "soon", 21.0)], "city string, time string, temperature double")
    found = refine.refine_weather(df, city_table(spark))
    assert "time" not in found.columns and dict(found.dtypes)["timestamp"] == "timestamp"
    assert rows(found, "uf", "city", "temperature", "timestamp") == [
        ("SP", "Santos", 20.0, datetime(2025, 6, 8, 12)), ("SP", "Santos", 21.0, None)]


def test_refined_air_quality_keeps_every_parameter(spark):
    df = spark.createDataFrame([("SP-Santos", "dew", 1.0)] * 2, "city string, parameter string, value double")
    assert rows(refine.refine_air_quality(df, city_table(spark)), "parameter", "lat") == [("dew", -23.9)]


def test_letter_ranges():
    assert letter_ranges("SP{A-C},bad,RJ{D-E},SP{X-Z}") == [("SP", "X", "Z"), ("RJ", "D", "E")]
    assert letter_ranges("") == [] and letter_ranges("SP{C-A}") == [("SP", "C", "A")]
    assert letter_ranges("sp{A-C}, RJ{A-B},MG{A-B}tail") == [("MG", "A", "B")]


def test_cities_in_ranges(spark):
    cities = spark.createDataFrame(
        [(c,) for c in ("SP-Águas", "SP-bauru", "SP-Hortolândia", "SP-Itu", "RJ-Duas-Barras", "NoHyphen", "SP-")],
        "city string")
    assert rows(cities_in_ranges(cities, "SP{A-H},RJ{D-F}")) == [
        ("RJ-Duas-Barras",), ("SP-Hortolândia",), ("SP-bauru",)]
    assert cities_in_ranges(cities, "").count() == 0
    assert cities_in_ranges(cities, "SP{C-A}").count() == 0


def test_contract_splits_and_names_reasons(spark):
    good = ("SP", "Santos", "t", "pm25", 1.0, "AQI", "WAQI", None, None)
    df = spark.createDataFrame(
        [good, (*good[:5], "ppm", "X", 1.0, 1.0), ("SP", None, *good[2:4], None, *good[5:])],
        "uf string, city string, timestamp string, parameter string, value double, unit string,"
        "source string, lat double, long double")
    valid, quarantined = ct.check_contract(df, ct.AIR_QUALITY_CONTRACT)
    assert rows(valid) == [good]
    assert sorted(r.violations for r in quarantined.collect()) == [
        ["city missing", "value missing"], ["unit not allowed", "source not allowed"]]


def test_contract_level(spark):
    base = {c: F.lit("x") for c in ct.WEATHER_ANOMALY_CONTRACT.columns}
    df = spark.createDataFrame([("alta",), ("severa",), (None,)], "anomaly_level string")
    df = df.withColumns({c: v for c, v in base.items() if c != "anomaly_level"})
    valid, bad = ct.check_contract(df, ct.WEATHER_ANOMALY_CONTRACT)
    assert (valid.count(), rows(bad, "anomaly_level")) == (2, [("alta",)])


def test_projection_order(spark):
    df = spark.range(1).select(*[F.lit(1).alias(c) for c in reversed(ct.WEATHER_CONTRACT.columns)], F.lit(2).alias("extra"))
    assert tuple(ct.project(df, ct.WEATHER_CONTRACT).columns) == ct.WEATHER_CONTRACT.columns
