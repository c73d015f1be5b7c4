"""The job runner on a small lake."""

from __future__ import annotations

import pytest

from skygauge.__main__ import arguments, run
from skygauge.sources.tables import load_refined
from tests.lake import fill, make_lake


@pytest.fixture
def lake(tmp_path):
    lake = make_lake(tmp_path)
    fill(lake)
    return lake


@pytest.mark.parametrize("job,table,count", [
    ("detect-weather", "weather_anomalies", 1),
    ("detect-airquality", "airquality_anomalies", 1),
    ("refine", "weather", 25),
    ("recent-weather", "weather_recent_anomalies", 1),
    ("recent-airquality", "airquality_recent_anomalies", 1),
])
def test_job_writes_its_table(spark, lake, job, table, count):
    run(spark, arguments([
        job, "--raw", lake.raw, "--refined", lake.refined, "--cities", lake.cities,
        "--as-of", "2025-06-08T14:00:00"]))
    assert load_refined(spark, lake, table).count() == count


def test_unknown_job_is_refused():
    with pytest.raises(SystemExit):
        arguments(["guess", "--raw", "x"])
