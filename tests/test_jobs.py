"""Batch, recent and serving jobs end to end on a small lake."""

from __future__ import annotations

from datetime import timedelta
from pathlib import Path

import pytest

from skygauge.operators import anomalies
from skygauge.operators import contracts as ct
from skygauge.plans import batch, recent, serving
from skygauge.session import scratch_root
from skygauge.sources.tables import load_refined, read_table
from tests.conftest import rows
from tests.lake import NOON, fill, make_lake, put_airquality


@pytest.fixture(scope="module")
def lake(spark, tmp_path_factory):
    """Every job run once over the same lake."""
    lake = make_lake(tmp_path_factory.mktemp("lake"))
    fill(lake)
    batch.detect_weather(spark, lake)
    batch.detect_air_quality(spark, lake)
    batch.refine_facts(spark, lake)
    recent.detect_recent_air_quality(spark, lake, NOON + timedelta(hours=2))
    assert recent.detect_recent_weather(spark, lake, NOON + timedelta(hours=2))
    return lake


def test_batch_air_quality(spark, lake):
    raw = read_table(spark, lake.raw_path("airquality_anomalies"))
    assert "hour" in raw.columns
    refined = load_refined(spark, lake, "airquality_anomalies")
    assert set(refined.columns) == {
        "city", "parameter", "value", "unit", "timestamp", "source", "avg_value", "std_value",
        "aqi_z_score", "anomaly_level", "Q1", "Q3", "IQR", "is_iqr_anomaly", "lat", "long", "uf"}
    assert rows(refined, "uf", "city", "value", "anomaly_level", "lat") == [
        ("SP", "Campinas", 90.0, "extrema", -22.9)]


def test_batch_weather(spark, lake):
    refined = load_refined(spark, lake, "weather_anomalies")
    assert {"time", "timestamp", "hour", "uf", "lat", "long"} <= set(refined.columns)
    assert rows(refined, "uf", "city", "temperature", "hour") == [("SP", "Campinas", 90.0, 12)]
    assert read_table(spark, lake.raw_path("weather_anomalies")).count() == 1


def test_refined_facts(spark, lake):
    weather = load_refined(spark, lake, "weather")
    assert "time" not in weather.columns
    assert rows(weather.groupBy("uf", "city", "lat").count()) == [
        ("RJ", "Rio", None, 12), ("SP", "Campinas", -22.9, 13)]
    air = load_refined(spark, lake, "airquality")
    assert rows(air.groupBy("city", "parameter").count()) == [
        ("Campinas", "dew", 1), ("Campinas", "pm25", 13), ("Rio", "pm10", 12), ("Santos", "o3", 12)]


def test_recent_results_are_separate_tables(spark, lake):
    assert load_refined(spark, lake, "airquality_recent_anomalies").count() == 1
    assert load_refined(spark, lake, "weather_recent_anomalies").count() == 1
    assert lake.raw_path("weather_anomalies") != lake.raw_path("weather_recent_anomalies")


def test_recent_weather_without_input_keeps_the_earlier_result(spark, lake):
    assert not recent.detect_recent_weather(spark, lake, NOON + timedelta(days=30))
    assert load_refined(spark, lake, "weather_recent_anomalies").count() == 1


def test_recent_air_quality_without_input_is_empty(spark, tmp_path):
    lake = make_lake(tmp_path)
    put_airquality(lake, NOON, [("SP-Santos", "o3", 1.0, NOON)])
    recent.detect_recent_air_quality(spark, lake, NOON + timedelta(days=30))
    assert load_refined(spark, lake, "airquality_recent_anomalies").count() == 0


def test_repeated_rows_count_in_statistics_but_appear_once(spark, tmp_path):
    lake = make_lake(tmp_path)
    values = [10.0, 11.0] * 10 + [90.0]
    records = [("SP-Santos", "o3", v, NOON + timedelta(minutes=i)) for i, v in enumerate(values)]
    put_airquality(lake, NOON, records + records[-1:])
    batch.detect_air_quality(spark, lake)
    assert read_table(spark, lake.raw_path("airquality_anomalies")).count() == 2
    refined = load_refined(spark, lake, "airquality_anomalies").collect()
    assert [round(r.avg_value, 6) for r in refined] == [round(sum(values + [90.0]) / 22, 6)]


QUERIES = [
    (serving.query_weather, ct.WEATHER_CONTRACT, 25, 13),
    (serving.query_weather_anomalies, ct.WEATHER_ANOMALY_CONTRACT, 1, 1),
    (serving.query_recent_weather_anomalies, ct.WEATHER_ANOMALY_CONTRACT, 1, 1),
    (serving.query_air_quality, ct.AIR_QUALITY_CONTRACT, 38, 14),
    (serving.query_air_quality_anomalies, ct.AIR_QUALITY_ANOMALY_CONTRACT, 1, 1),
    (serving.query_recent_air_quality_anomalies, ct.AIR_QUALITY_ANOMALY_CONTRACT, 1, 1),
]


@pytest.mark.parametrize("run,contract,total,in_campinas", QUERIES)
def test_serving_queries(spark, lake, run, contract, total, in_campinas):
    everything = run(spark, lake)
    assert tuple(everything.columns) == contract.columns
    assert everything.count() == total
    assert run(spark, lake, uf="sp", city="CAMPINAS").count() == in_campinas
    assert run(spark, lake, limit=5, offset=total - 1).count() == 1
    valid, bad = ct.check_contract(everything, contract)
    assert (valid.count(), bad.count()) == (total, 0)


def test_serving_order_and_range(spark, lake):
    page = serving.query_air_quality(spark, lake, limit=3).collect()
    assert [r.timestamp for r in page] == [NOON - timedelta(days=1) + timedelta(minutes=i) for i in range(3)]
    assert serving.query_air_quality(spark, lake, date_to="2025-06-08").count() == 12
    assert serving.query_air_quality(spark, lake, date_from="08-06-2025").count() == 26
    with pytest.raises(ValueError):
        serving.query_air_quality(spark, lake, date_from="nonsense")


def test_served_z_score_is_the_score(spark, lake):
    row = serving.query_air_quality_anomalies(spark, lake).first()
    assert row.aqi_z_score > 3 and row.aqi_z_score != row.std_value


def test_flat_refined_tables_serve_alike(spark, lake, tmp_path_factory):
    flat = make_lake(tmp_path_factory.mktemp("flat"))
    fill(flat)
    batch.refine_facts(spark, flat, by_day=False)
    assert "obs_date" not in load_refined(spark, flat, "weather").columns
    for run in (serving.query_weather, serving.query_air_quality):
        assert rows(run(spark, flat, date_from="2025-06-08")) == rows(run(spark, lake, date_from="2025-06-08"))


def test_non_finite_numbers_are_cleaned_for_serving(spark, tmp_path):
    lake = make_lake(tmp_path)
    put_airquality(lake, NOON, [("SP-Santos", "o3", v, NOON + timedelta(minutes=i))
                                for i, v in enumerate([1.0, 2.0, float("inf")])])
    batch.detect_air_quality(spark, lake)
    served = serving.query_air_quality_anomalies(spark, lake).collect()
    assert [(r.value, r.std_value, r.aqi_z_score, r.anomaly_level) for r in served] == [
        (1.0, 0.0, 0.0, "extrema"), (2.0, 0.0, 0.0, "extrema"), (None, 0.0, 0.0, "extrema")]


def left_behind(spark, lake, job):
    folder = Path(scratch_root(spark)) / "skygauge" / lake.job(job)
    return sorted(p.name for p in folder.iterdir()) if folder.exists() else []


def test_runs_leave_no_scratch(spark, tmp_path):
    lake = make_lake(tmp_path)
    fill(lake)
    for _ in range(2):
        recent.detect_recent_air_quality(spark, lake, NOON + timedelta(hours=2))
        assert load_refined(spark, lake, "airquality_recent_anomalies").count() == 1
    batch.detect_weather(spark, lake)
    assert left_behind(spark, lake, "recent-airquality") == left_behind(spark, lake, "detect-weather") == []


def test_a_run_that_fails_leaves_no_scratch(spark, tmp_path):
    lake = make_lake(tmp_path)
    fill(lake)
    Path(lake.cities).write_text("[]")
    with pytest.raises(Exception):
        recent.detect_recent_air_quality(spark, lake, NOON + timedelta(hours=2))
    assert left_behind(spark, lake, "recent-airquality") == []


def test_overlapping_runs_do_not_disturb_each_other(spark, tmp_path, monkeypatch):
    """A run that starts and ends between another's statistics and its scoring."""
    lake = make_lake(tmp_path)
    fill(lake)
    alone = {}
    for hours in (2, 4):
        recent.detect_recent_air_quality(spark, lake, NOON + timedelta(hours=hours), hours * 3600)
        alone[hours] = rows(load_refined(spark, lake, "airquality_recent_anomalies"))
    inner, score = [], anomalies.score

    def interrupted(*args, **options):
        if not inner:
            inner.append(None)
            recent.detect_recent_air_quality(spark, lake, NOON + timedelta(hours=4), 4 * 3600)
            inner[0] = rows(load_refined(spark, lake, "airquality_recent_anomalies"))
        return score(*args, **options)

    monkeypatch.setattr(anomalies, "score", interrupted)
    recent.detect_recent_air_quality(spark, lake, NOON + timedelta(hours=2), 2 * 3600)
    assert inner == [alone[4]]
    assert rows(load_refined(spark, lake, "airquality_recent_anomalies")) == alone[2]
    assert left_behind(spark, lake, "recent-airquality") == []


def test_a_query_that_began_before_a_rerun_reads_the_old_rows(spark, tmp_path):
    lake = make_lake(tmp_path)
    fill(lake)
    batch.refine_facts(spark, lake, ["airquality"])
    begun = load_refined(spark, lake, "airquality")
    before = rows(begun)
    put_airquality(lake, NOON, [("SP-Santos", "o3", 1.0, NOON)])
    batch.refine_facts(spark, lake, ["airquality"])
    assert rows(begun) == before
    assert load_refined(spark, lake, "airquality").count() == len(before) + 1


def test_a_failed_job_leaves_the_earlier_table(spark, tmp_path):
    lake = make_lake(tmp_path)
    fill(lake)
    batch.refine_facts(spark, lake, ["airquality"])
    before = rows(load_refined(spark, lake, "airquality"))
    Path(lake.cities).write_text('{"broken')
    with pytest.raises(Exception):
        batch.refine_facts(spark, lake, ["airquality"])
    assert rows(load_refined(spark, lake, "airquality")) == before
