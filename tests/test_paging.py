"""Ordered pages near the start and deep, and the serving filters."""

from __future__ import annotations

import random
from datetime import datetime, timedelta

import pytest

from skygauge import files, session
from skygauge.operators import paging
from skygauge.sources.tables import indexed_table, read_table, write_table
from tests.conftest import plan, rows

START = datetime(2025, 6, 1)


def observations(spark, n=400):
    """Times over ten days with NULLs, ties, and a third of the rows one copy."""
    rng = random.Random(3)
    data = [(START + timedelta(hours=5), 1)] * (n // 3)
    data += [(START + timedelta(minutes=rng.randrange(14_400)), rng.randrange(9)) for _ in range(n // 2)]
    data += [(None, rng.randrange(5)) for _ in range(n - len(data))]
    return spark.createDataFrame(data, "timestamp timestamp_ntz, x int").repartition(6), data


def ordered(data):
    return sorted(data, key=lambda r: (r[0] is None, r[0] or START, r[1]))


PAGES = [(0, 10), (100, 50), (130, 10), (260, 90), (390, 50), (400, 10), (0, 1000), (20, 0)]


@pytest.mark.parametrize("offset,limit", PAGES)
@pytest.mark.parametrize("bounds", [{}, {"top_k_rows": -1}, {"top_k_rows": -1, "one_slice_rows": 0}])
def test_page_equals_slice(spark, offset, limit, bounds):
    df, data = observations(spark)
    found = [tuple(r) for r in paging.page(df, limit, offset, **bounds).collect()]
    assert found == ordered(data)[offset:offset + limit]


def test_pages_concatenate_to_the_whole(spark):
    df, data = observations(spark, 120)
    found = []
    for offset in range(0, 120, 37):
        found += [tuple(r) for r in paging.page(df, 37, offset).collect()]
    assert found == ordered(data)


def test_shallow_page_is_a_top_k(spark):
    df, _ = observations(spark)
    assert "TakeOrderedAndProject" in plan(paging.page(df, 10))


def test_negative_paging_is_refused(spark):
    df, _ = observations(spark)
    for bad in ({"limit": -1}, {"offset": -1}):
        with pytest.raises(ValueError):
            paging.page(df, **bad)


def days(spark):
    times = [datetime(2025, 6, 7, 23), datetime(2025, 6, 8), datetime(2025, 6, 8, 0, 1), datetime(2025, 6, 9), None]
    return spark.createDataFrame([(t,) for t in times], "timestamp timestamp_ntz")


def test_bounds_are_day_starts_and_inclusive(spark):
    assert paging.date_range(days(spark), date_to="2025-06-08").count() == 2
    assert paging.date_range(days(spark), date_from="2025-06-08T15:30").count() == 3
    assert paging.date_range(days(spark), "08-06-2025", "2025-06-09").count() == 3
    assert paging.date_range(days(spark)).count() == 5
    exact = paging.date_range(days(spark), "2025-06-08T00:01", truncate_bounds=False)
    assert exact.count() == 2


def test_place_ignores_case(spark):
    df = spark.createDataFrame([("SP", "São Paulo"), ("RJ", "Niterói"), (None, None)], "uf string, city string")
    assert rows(paging.place(df, "sp", "são paulo")) == [("SP", "São Paulo")]
    assert paging.place(df).count() == 3
    assert paging.place(df, uf="mg").count() == 0


@pytest.mark.parametrize("offset,limit", PAGES)
def test_page_of_a_table_by_day(spark, tmp_path, offset, limit):
    df, data = observations(spark)
    write_table(df, str(tmp_path / "t"), by_day=True)
    table = read_table(spark, str(tmp_path / "t"))
    rows_, rest = paging.days_of_page(table, limit, offset)
    found = [tuple(r) for r in paging.page(rows_.drop("obs_date"), limit, rest).collect()]
    assert found == ordered(data)[offset:offset + limit]


def test_page_of_a_table_by_day_reads_its_days_only(spark, tmp_path):
    df, _ = observations(spark)
    write_table(df, str(tmp_path / "t"), by_day=True)
    rows_, rest = paging.days_of_page(read_table(spark, str(tmp_path / "t")), 10, 200)
    assert "PartitionFilters: [isnotnull(obs_date" in plan(rows_) and rest < 200


def test_signed_zeros_are_one_value_on_every_way(spark):
    df = spark.createDataFrame([(START, -0.0), (START, 0.0), (START, -0.0)], "timestamp timestamp, value double")
    for bounds in ({}, {"top_k_rows": 0}, {"top_k_rows": 0, "one_slice_rows": 0}):
        found = paging.page(df, 2, 0, **bounds).collect()
        assert [str(r["value"]) for r in found] == ["0.0", "0.0"]


@pytest.mark.parametrize("offset,limit", PAGES)
def test_page_by_the_stored_counts(spark, tmp_path, offset, limit):
    df, data = observations(spark)
    write_table(df, str(tmp_path / "t"), by_day=True)
    table, index = indexed_table(spark, str(tmp_path / "t"))
    rows_, rest = paging.hours_of_page(table, index, limit, offset)
    found = [tuple(r) for r in paging.page(rows_.drop("obs_date"), limit, rest).collect()]
    assert found == ordered(data)[offset:offset + limit]


FILTERS = [{"date_from": "2025-06-03"}, {"date_to": "2025-06-04"}, {"date_from": "2025-06-02", "date_to": "2025-06-06"},
           {"uf": "sp"}, {"uf": "RJ", "city": "niterói", "date_to": "08-06-2025"}, {"city": "nowhere"}]


@pytest.mark.parametrize("filters", FILTERS)
def test_filtered_pages_by_the_stored_counts(spark, tmp_path, filters):
    """Some rows lie exactly on a bound, others in the hour after it."""
    rng = random.Random(11)
    places = [("SP", "Santos"), ("RJ", "Niterói"), ("SP", None)]
    data = [(START + timedelta(days=rng.randrange(9), minutes=rng.choice([0, 0, 1, 59, 60, 700])), i, *rng.choice(places))
            for i in range(300)]
    df = spark.createDataFrame(data + [(None, 1000, "SP", "Santos")], "timestamp timestamp_ntz, x int, uf string, city string")
    write_table(df, str(tmp_path / "t"), by_day=True)
    table, index = indexed_table(spark, str(tmp_path / "t"))
    dates = {k: v for k, v in filters.items() if k.startswith("date")}
    places_ = {k: v for k, v in filters.items() if not k.startswith("date")}
    wanted = paging.place(paging.date_range(table, **dates), **places_)
    everything = [tuple(r) for r in paging.by_time(wanted.drop("obs_date")).collect()]
    for offset, limit in ((0, 20), (40, 30), (len(everything) - 1, 5), (len(everything), 5)):
        if offset < 0:
            continue
        rows_, rest = paging.hours_of_page(wanted, index, limit, offset, **filters)
        assert [tuple(r) for r in paging.page(rows_.drop("obs_date"), limit, rest).collect()] == everything[offset:offset + limit]


def test_a_page_by_the_stored_counts_reads_its_hours_only_and_stores_nothing(spark, tmp_path, monkeypatch):
    df, _ = observations(spark)
    write_table(df, str(tmp_path / "t"), by_day=True)
    table, index = indexed_table(spark, str(tmp_path / "t"))
    monkeypatch.setattr(session, "materialize", None)
    monkeypatch.setattr(paging, "materialize", None)
    rows_, rest = paging.hours_of_page(table, index, 10, 200)
    text = plan(rows_)
    assert "PartitionFilters: [isnotnull(obs_date" in text and "GreaterThanOrEqual(timestamp" in text and rest < 50
    assert paging.page(rows_, 10, rest).count() == 10


def test_a_ranked_page_keeps_its_rows_only(spark):
    df, _ = observations(spark)
    with session.scratch_of(spark, "pages") as folder:
        assert paging.page(df, 50, 100, top_k_rows=-1, one_slice_rows=0).count() == 50
        assert [e.name.split("-", 1)[1] for e in files.entries(spark, folder) if e.folder] == ["page"]
