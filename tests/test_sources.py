"""Readers, writers and their pruning."""

from __future__ import annotations

from datetime import datetime, timedelta
from pathlib import Path

import pandas as pd
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from skygauge import schemas
from skygauge.functions import payloads
from skygauge.plans import batch
from skygauge.sources import landed, tables
from tests.conftest import plan, rows
from tests.lake import NOON, fill, make_lake, put_airquality, put_weather


@pytest.fixture
def lake(tmp_path):
    lake = make_lake(tmp_path)
    fill(lake)
    return lake


def test_airquality_reads_all_days_without_partition_columns(spark, lake):
    df = landed.read_airquality(spark, lake.raw_path("airquality"))
    assert df.columns == ["city", "parameter", "value", "unit", "timestamp", "source"]
    assert df.count() == 13 + 12 + 1 + 12
    assert dict(df.dtypes)["timestamp"] == "timestamp_ntz"


def test_recent_airquality_prunes_to_touched_days(spark, lake):
    root = lake.raw_path("airquality")
    put_airquality(lake, NOON - timedelta(days=40), [("SP-Santos", "o3", 1.0, NOON)])
    day = landed.read_recent_airquality(spark, root, NOON)
    assert day.count() == 26
    text = plan(day)
    assert "PartitionFilters: [isnotnull(year" in text
    across = landed.read_recent_airquality(spark, root, datetime(2025, 6, 8, 1, 0))
    assert across.count() == 38
    assert landed.read_recent_airquality(spark, root, datetime(2025, 7, 1, 12, 0)).count() == 0


def test_cutoff_is_in_whole_seconds_and_pushed_down(spark, lake):
    df = landed.read_airquality(spark, lake.raw_path("airquality"))
    as_of = NOON + timedelta(hours=2, microseconds=900_000)
    kept = landed.since_cutoff(df, as_of)
    assert kept.count() == 26
    assert "GreaterThanOrEqual(timestamp,2025-06-08T12:00)" in plan(kept)
    assert landed.since_cutoff(df, as_of + timedelta(seconds=1)).count() == 26 - 3


def test_cutoff_on_text_time(spark, lake):
    df = landed.read_weather(spark, lake.raw_path("weather"))
    assert landed.since_cutoff(df, NOON + timedelta(hours=2), column="time").count() == 13


def test_weather_reads_every_city(spark, lake):
    df = landed.read_weather(spark, lake.raw_path("weather"))
    assert df.count() == 25
    assert rows(df.select("city").distinct()) == [("RJ-Rio-Bonito",), ("SP-Campinas",)]


def test_recent_weather_uses_the_file_name(spark, lake):
    root = lake.raw_path("weather")
    put_weather(lake, "SP-Santos", NOON + timedelta(minutes=30), "2020-01-01T00:00", 5.0)
    as_of = NOON + timedelta(hours=2)
    recent = landed.read_recent_weather_files(spark, root, as_of)
    assert recent.count() == 14
    assert landed.read_recent_weather_files(spark, root, as_of, lookback=5400).count() == 1


def test_recent_weather_opens_only_recent_files(spark, lake):
    """An old file that is no longer readable does no harm."""
    folder = Path(lake.raw_path("weather")) / "SP-Old"
    folder.mkdir()
    (folder / "20200101-000000.json").write_bytes(b"\xff\xfe broken")
    recent = landed.read_recent_weather_files(
        spark, lake.raw_path("weather"), NOON + timedelta(hours=2))
    assert recent.filter("city IS NULL").count() == 0
    assert recent.count() == 13
    assert recent.select(F.input_file_name()).distinct().count() == 13


def test_filing_by_date_leaves_the_other_days_unlisted(spark, lake):
    root, as_of = lake.raw_path("weather"), NOON + timedelta(hours=2)
    put_weather(lake, "SP-Santos", NOON - timedelta(days=400), "2024-01-01T00:00", 5.0)
    before = {look: rows(landed.read_recent_weather_files(spark, root, as_of, look)) for look in (5400, 7200, 10 * 86400)}
    (Path(root) / "SP-Santos" / "notes.txt").write_text("not a landing")
    whole = rows(landed.read_weather(spark, root).filter("city IS NOT NULL"))
    assert landed.file_weather_by_date(spark, root) == 26
    assert landed.file_weather_by_date(spark, root) == 0
    assert {p.name for p in Path(root).glob("ingest_date=*")} == {
        "ingest_date=2025-06-08", "ingest_date=2025-06-05", "ingest_date=2024-05-04"}
    for look, expected in before.items():
        assert rows(landed.read_recent_weather_files(spark, root, as_of, look)) == expected
    folders = landed.recent_folders(spark, root, as_of - timedelta(hours=2))
    assert sorted(f.rpartition("/")[2] for f in folders) == ["RJ-Rio-Bonito", "SP-Campinas", "SP-Santos", "ingest_date=2025-06-08"]
    files_read = landed.read_recent_weather_files(spark, root, as_of).inputFiles()
    assert files_read and not any("2025-06-05" in f or "2024-05-04" in f for f in files_read)
    assert rows(landed.read_weather(spark, root).filter("city IS NOT NULL")) == whole
    # What comes next lies in the city's folder until it is filed.
    put_weather(lake, "SP-Santos", NOON + timedelta(hours=1), "2025-06-08T13:00", 7.0)
    assert landed.read_recent_weather_files(spark, root, as_of).count() == len(before[7200]) + 1


def test_recent_weather_of_a_folder_that_is_not_there(spark, tmp_path):
    found = landed.read_recent_weather_files(spark, str(tmp_path / "none"), NOON)
    assert found.count() == 0 and found.columns[0] == "city"


def test_cities_rename_coordinates(spark, lake):
    assert rows(landed.read_cities(spark, lake.cities), "city", "lat", "long") == [
        ("SP-Campinas", -22.9, -47.1), ("SP-Santos", -23.9, -46.3),
        ("SP-Águas de Lindóia", -22.5, -46.6)]


def versions(path):
    return sorted(p.name for p in Path(path).iterdir())


def test_write_replaces_the_table(spark, tmp_path):
    path = str(tmp_path / "t")
    tables.write_table(spark.range(5), path)
    old = tables.read_table(spark, path)
    tables.write_table(spark.range(3), path)
    assert tables.read_table(spark, path).count() == 3 and old.count() == 5
    assert len(versions(path)) == 2
    tables.write_table(tables.read_table(spark, path).filter("id > 0"), path, keep_seconds=-1)
    assert rows(tables.read_table(spark, path)) == [(1,), (2,)] and len(versions(path)) == 1


def test_a_failed_or_unfinished_write_is_not_read(spark, tmp_path):
    path = str(tmp_path / "t")
    tables.write_table(spark.range(5), path)
    with pytest.raises(Exception, match="no such row"):
        tables.write_table(spark.range(9).select(F.raise_error(F.lit("no such row")).alias("id")), path)
    spark.range(7).write.parquet(f"{path}/v-99990101T000000000000-0")  # written, not published
    assert tables.read_table(spark, path).count() == 5
    tables.write_table(spark.range(6), path, keep_seconds=-1)
    assert tables.read_table(spark, path).count() == 6
    assert len(versions(path)) >= 2  # that of a writer which may be at work still


def test_a_plain_folder_is_a_table(spark, tmp_path):
    spark.range(4).write.parquet(str(tmp_path / "t"))
    assert tables.read_table(spark, str(tmp_path / "t")).count() == 4
    tables.write_table(spark.range(2), str(tmp_path / "t"))
    assert tables.read_table(spark, str(tmp_path / "t")).count() == 2


def test_write_by_day_prunes_and_counts(spark, tmp_path):
    path = str(tmp_path / "t")
    df = spark.range(96).select((F.lit("2025-06-01 00:00:00").cast("timestamp_ntz")
                                 + F.make_dt_interval(mins=F.col("id") * 90)).alias("timestamp"),
                                F.lit("SP").alias("uf"))
    tables.write_table(df.union(spark.sql("SELECT CAST(NULL AS TIMESTAMP_NTZ), 'RJ'")), path, by_day=True)
    assert {p.name for p in Path(tables.current(spark, path).removeprefix("file:")).glob("obs_date=*")} == {
        *(f"obs_date=2025-06-0{d}" for d in range(1, 7)), "obs_date=__HIVE_DEFAULT_PARTITION__"}
    table = tables.read_table(spark, path)
    assert table.count() == 97 and table.columns == ["timestamp", "uf", "obs_date"]
    index = tables.indexed_table(spark, path)[1]
    assert index.columns == ["hour", "uf", "rows", "at_start"]
    assert index.agg(F.sum("rows"), F.sum("at_start")).first()[:] == (97, 48)
    assert rows(index.filter("hour IS NULL"), "uf", "rows", "at_start") == [("RJ", 1, 0)]


def test_a_table_by_day_without_rows(spark, tmp_path):
    path = str(tmp_path / "t")
    empty = spark.createDataFrame([], "timestamp timestamp_ntz, uf string, city string")
    tables.write_table(empty, path, by_day=True)
    assert tables.read_table(spark, path).count() == 0
    assert tables.indexed_table(spark, path)[1].count() == 0


def test_preview_projects_and_limits(spark):
    df = spark.range(50).withColumn("x", F.lit(1))
    assert tables.preview(df, ["x"]).columns == ["x"]
    assert tables.preview(df, ["x"]).count() == 10


def test_values_stored_as_integers_are_read(spark, tmp_path):
    folder = tmp_path / "year=2025" / "month=06" / "day=08"
    folder.mkdir(parents=True)
    pd.DataFrame({"city": ["SP-Santos"], "parameter": ["o3"], "value": [7], "timestamp": [NOON]}).to_parquet(
        folder / "a.parquet", coerce_timestamps="us")
    found = landed.read_airquality(spark, str(tmp_path))
    assert dict(found.dtypes)["value"] == "double"
    assert rows(found, "value", "unit") == [(7.0, None)]
    assert landed.read_recent_airquality(spark, str(tmp_path), NOON).count() == 1


def test_an_empty_folder_reads_as_no_rows(spark, tmp_path):
    assert landed.read_airquality(spark, str(tmp_path)).count() == 0
    assert landed.read_recent_airquality(spark, str(tmp_path), NOON).count() == 0


def test_whole_numbers_may_be_written_as_floats(spark, tmp_path):
    (tmp_path / "a.json").write_text('{"city": "SP-Santos", "winddirection": 262.0, "is_day": 1, "temperature": 20}')
    found = landed.read_weather(spark, str(tmp_path))
    assert rows(found, "winddirection", "is_day", "temperature") == [(262, 1, 20.0)]
    assert dict(found.dtypes)["winddirection"] == "int"


def test_fractions_and_overflows_are_no_whole_numbers(spark, tmp_path):
    good = ['{"city": "A", "winddirection": 90, "interval": 2147483647}', '{"city": "B", "winddirection": 262.0}',
            '{"city": "C", "is_day": null, "temperature": 1.5}']
    bad = ['{"city": "D", "winddirection": 90.7}', '{"city": "E", "interval": 99999999999}',
           '{"city": "F", "weathercode": -2147483649}']
    (tmp_path / "a.json").write_text("\n".join([*good, *bad, ""]))
    root = str(tmp_path)
    assert rows(landed.read_weather(spark, root), "city", "winddirection") == sorted([("A", 90), ("B", 262), ("C", None)])
    assert rows(landed.rejected_weather(spark, root), "line") == sorted((b,) for b in bad)
    nested = T.StructType().add("w", schemas.WEATHER).add("city", "string")
    df = spark.createDataFrame([('{"w": {"is_day": 0.5}}',), ('{"w": {"is_day": 1.0}}',), ('{"city": "x"}',)], "value string")
    assert rows(payloads.unreadable(payloads.decode_json(df, "value", nested))) == [('{"w": {"is_day": 0.5}}',)]


def test_jobs_store_the_lines_they_leave_out(spark, lake):
    folder = Path(lake.raw_path("weather")) / "UF-Broken"
    folder.mkdir()
    (folder / "20250608-120000.json").write_text('{"city": "UF-Broken", "is_day": 0.5}\nnot json\n')
    for job in (batch.detect_weather, lambda s, k: batch.refine_facts(s, k, ["weather"])):
        job(spark, lake)
        aside = tables.read_table(spark, lake.raw_path("weather_unreadable_lines"))
        assert rows(aside, "line") == [("not json",), ('{"city": "UF-Broken", "is_day": 0.5}',)]
        assert aside.first().file.endswith("UF-Broken/20250608-120000.json")
    (folder / "20250608-120000.json").unlink()
    batch.refine_facts(spark, lake, ["weather"])
    assert tables.read_table(spark, lake.raw_path("weather_unreadable_lines")).count() == 0


def test_broken_weather_lines_are_set_aside(spark, lake):
    root = lake.raw_path("weather")
    good = landed.read_weather(spark, root)
    before = good.count()
    folder = Path(root) / "UF-Broken"
    folder.mkdir()
    broken = ["not json", '{"city": "UF-Broken", "temperature": "warm"}', '{"city": "UF-Broken"']
    (folder / "20250608-120000.json").write_text("\n".join(broken) + "\n")
    assert landed.read_weather(spark, root).count() == before
    assert landed.read_weather(spark, root).filter("city = 'UF-Broken'").select("city").count() == 0
    assert rows(landed.rejected_weather(spark, root).select("line")) == sorted((line,) for line in broken)


@pytest.mark.parametrize("text", ["{}", '{"SP-Santos": {"lat": 1', "[1, 2]"])
def test_broken_city_file_fails(spark, tmp_path, text):
    (tmp_path / "cities.json").write_text(text)
    with pytest.raises(Exception):
        landed.read_cities(spark, str(tmp_path / "cities.json")).collect()


def test_last_entry_of_a_city_counts(spark, tmp_path):
    (tmp_path / "cities.json").write_text(
        '{"A": {"lat": 1.0, "lon": 2.0}, "B": {"lat": 3.0, "lon": 4.0}, "A": {"lat": 5.0, "lon": 6.0}}')
    found = landed.read_cities(spark, str(tmp_path / "cities.json"))
    assert rows(found) == [("A", 5.0, 6.0), ("B", 3.0, 4.0)]
