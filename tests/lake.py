"""A small lake in the layouts that the collectors write."""

from __future__ import annotations

import json
from datetime import datetime, timedelta
from pathlib import Path

import pandas as pd

from skygauge.sources.tables import Lake

CITIES = {
    "SP-Campinas": {"lat": -22.9, "lon": -47.1},
    "SP-Santos": {"lat": -23.9, "lon": -46.3},
    "SP-Águas de Lindóia": {"lat": -22.5, "lon": -46.6},
}

NOON = datetime(2025, 6, 8, 12, 0)


def make_lake(root: Path) -> Lake:
    cities = root / "city_table.json"
    cities.write_text(json.dumps(CITIES, ensure_ascii=False, indent=2), encoding="utf-8")
    return Lake(raw=str(root / "raw"), refined=str(root / "refined"), cities=str(cities))


def put_airquality(lake: Lake, day: datetime, records: list[tuple]) -> None:
    """One Parquet file in the directory of ``day``: (city, parameter, value, time)."""
    folder = Path(lake.raw_path("airquality")) / day.strftime("year=%Y/month=%m/day=%d")
    folder.mkdir(parents=True, exist_ok=True)
    frame = pd.DataFrame(
        [(c, p, v, "AQI", t, "WAQI") for c, p, v, t in records],
        columns=["city", "parameter", "value", "unit", "timestamp", "source"])
    frame["value"] = frame["value"].astype("float64")
    name = f"airquality_{day:%Y%m%d}-{len(list(folder.iterdir())):06d}.parquet"
    frame.to_parquet(folder / name, index=False, coerce_timestamps="us")


def put_weather(lake: Lake, city: str, ingested: datetime, time: str, temperature: float) -> None:
    """One JSON file in the directory of ``city``, named by ingestion time."""
    folder = Path(lake.raw_path("weather")) / city
    folder.mkdir(parents=True, exist_ok=True)
    document = {
        "time": time, "interval": 900, "temperature": temperature, "windspeed": 5.5,
        "winddirection": 90, "is_day": 1, "weathercode": 3, "city": city,
    }
    (folder / f"{ingested:%Y%m%d-%H%M%S}.json").write_text(
        json.dumps(document, ensure_ascii=False), encoding="utf-8")


SPIKE = [10.0, 11.0, 12.0, 11.0, 10.0, 12.0, 11.0, 10.0, 12.0, 11.0, 10.0, 12.0, 90.0]


def fill(lake: Lake) -> None:
    """A spike per fact in Campinas, usual readings in a city without coordinates."""
    minute = timedelta(minutes=1)
    put_airquality(lake, NOON, [
        ("SP-Campinas", "pm25", v, NOON + i * minute) for i, v in enumerate(SPIKE)
    ] + [("RJ-Rio-Bonito", "pm10", float(i % 3), NOON + i * minute) for i in range(12)]
      + [("SP-Campinas", "dew", 3.0, NOON)])
    put_airquality(lake, NOON - timedelta(days=1), [
        ("SP-Santos", "o3", 20.0 + i % 2, NOON - timedelta(days=1) + i * minute)
        for i in range(12)])
    for i, v in enumerate(SPIKE):
        put_weather(lake, "SP-Campinas", NOON + i * minute, f"2025-06-08T12:{i:02d}", v)
    for i in range(12):
        put_weather(lake, "RJ-Rio-Bonito", NOON - timedelta(days=3) + i * minute,
                    f"2025-06-05T12:{i:02d}", 20.0 + i % 3)
