"""Column expressions on literal values, against the standard library."""

from __future__ import annotations

import json
import re
import unicodedata
from datetime import datetime
from urllib.parse import quote

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from skygauge import functions as sf
from skygauge.functions.times import day_bound


def values(spark, texts, expression):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    return [r[1] for r in df.select("i", expression(F.col("t"))).orderBy("i").collect()]


def test_city_key_parts(spark):
    keys = ["SP-Embu-Guaçu", "NoHyphen", None, "sp-Santos", "SP-"]
    assert values(spark, keys, sf.uf_part) == ["SP", "NOHYPHEN", None, "SP", "SP"]
    assert values(spark, keys, sf.city_part) == ["Embu", None, None, "Santos", ""]
    assert values(spark, keys, lambda c: sf.city_part(c, keep_tail=True)) == [
        "Embu-Guaçu", None, None, "Santos", ""]


def test_event_time_is_lenient(spark):
    found = values(spark, ["2025-06-08T12:00", "2025-06-08 12:00:01", "soon", "", None], sf.event_time)
    assert found == [datetime(2025, 6, 8, 12), datetime(2025, 6, 8, 12, 0, 1), None, None, None]


def test_landing_time_falls_back_to_ingestion(spark):
    ingested = F.lit("2025-01-01 00:00:00").cast("timestamp")
    found = values(spark, ["2025-06-08 12:00:00", "soon", None], lambda c: sf.landing_time(c, ingested))
    assert found == [datetime(2025, 6, 8, 12), datetime(2025, 1, 1), datetime(2025, 1, 1)]


def test_file_name_time(spark):
    paths = ["s3://raw/weather/SP-X/20250608-120001.json", "weather/20250608-120001.txt",
             "weather/20251308-120001.json", "20250608-120001.json"]
    assert values(spark, paths, sf.file_name_time) == [datetime(2025, 6, 8, 12, 0, 1), None, None, None]


DAY_TEXTS = ["2025-06-08", "2025-06-08T15:30", "2025-06-08 23:59:59", "08-06-2025", "20250608",
             "2025-06-08T23:30:00-03:00"]


def test_to_day_drops_the_time(spark):
    found = values(spark, DAY_TEXTS, sf.to_day)
    assert found == [datetime(2025, 6, 8)] * len(DAY_TEXTS)
    assert values(spark, ["12:00", "nonsense", "2025-13-01", None, "2025-06-08Tzz"], sf.to_day) == [None] * 5


def test_day_bound_agrees_with_to_day(spark):
    assert [day_bound(t) for t in DAY_TEXTS] == [datetime(2025, 6, 8)] * len(DAY_TEXTS)
    assert day_bound("2025-06-08T15:30", truncate=False) == datetime(2025, 6, 8, 15, 30)
    with pytest.raises(ValueError):
        day_bound("nonsense")


def test_date_texts(spark):
    when = F.lit("2025-06-08 15:30:00").cast("timestamp_ntz")
    row = spark.range(1).select(
        sf.date_string(when), sf.date_string(when, "display"),
        sf.date_string(when, "iso_date_only"), sf.time_string(when)).first()
    assert tuple(row) == ("2025-06-08T00:00:00", "08-06-2025", "2025-06-08", "08-06-2025")


def test_partition_dates_are_padded(spark):
    when = F.lit("2025-06-08 23:00:00").cast("timestamp_ntz")
    parts = [c.alias(n) for n, c in sf.partition_dates(when).items()]
    assert spark.range(1).select(*parts).first().asDict() == {"year": 2025, "month": "06", "day": "08"}


def test_slugify_example(spark):
    assert values(spark, ["SP-São José dos Campos ", "--A  B--", "Ünïted; ñandú!", "", None], sf.slugify) == [
        "sp-sao-jose-dos-campos", "a-b", "united-nandu", "", None]


def test_is_json(spark):
    valid = ['{"a": 1}', "[1, 2]", "3", " 3 ", "null", "true", '"x"', "1e5"]
    invalid = ["{", "word", "", "3 foo", '{"a":1} x', "[1] [2]", "1,2", '1,"a":2', "[1]]",
               '{"a":1}}', "01", "nullx", "1] [2", "1} {", None]
    assert values(spark, valid + invalid, sf.is_json) == [True] * len(valid) + [False] * len(invalid)
    for text in valid + invalid[:-1]:
        assert python_accepts(text) == (text in valid)


def python_accepts(text):
    try:
        json.loads(text)
        return True
    except ValueError:
        return False


LATIN = st.text(st.characters(codec="latin-1", exclude_characters="\x00"), max_size=30)


@settings(max_examples=10, deadline=None, derandomize=True, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(LATIN, min_size=5, max_size=30))
def test_url_encode_equals_library_quote(spark, texts):
    assert values(spark, texts, sf.url_encode) == [quote(t) for t in texts]


@settings(max_examples=10, deadline=None, derandomize=True, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(LATIN, min_size=5, max_size=30))
def test_slug_shape(spark, texts):
    for text, slug in zip(texts, values(spark, texts, sf.slugify)):
        assert re.fullmatch(r"([a-z0-9]+(-[a-z0-9]+)*)?", slug)
        bare = unicodedata.normalize("NFD", text.lower())
        assert len(slug) <= len(bare)
