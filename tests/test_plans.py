"""Shapes of the plans that matter at scale."""

from __future__ import annotations

import re

import pytest

from skygauge.operators import anomalies as an
from skygauge.operators import quantiles, refine
from skygauge.operators.anomalies import AIR_QUALITY
from skygauge.session import scratch_root
from skygauge.suite import QUERIES
from tests.conftest import plan
from tests.test_anomalies import readings
from tests.test_registered import SF_DIR


@pytest.fixture
def facts(spark, tmp_path):
    df = readings(spark, [float(i % 9) for i in range(60)])
    df.write.parquet(str(tmp_path / "facts"))
    return spark.read.parquet(str(tmp_path / "facts"))


def exchanges(text):
    return re.findall(r"^\(\d+\) Exchange$", text, re.MULTILINE)


def test_scoring_does_not_shuffle_the_facts(spark, facts):
    prepared = an.prepare(facts, AIR_QUALITY)
    scored = an.only_anomalies(
        an.score(prepared, an.baseline(prepared, AIR_QUALITY), AIR_QUALITY), AIR_QUALITY)
    text = plan(scored)
    fact_side = text[:text.index("BroadcastHashJoin Inner")]
    assert "Exchange" not in fact_side and "SortMergeJoin" not in text
    assert text.count("BroadcastHashJoin Inner") >= 1


def test_filters_reach_the_scan(spark, facts):
    text = plan(an.prepare(facts, AIR_QUALITY))
    pushed = re.search(r"PushedFilters: \[(.*)\]", text).group(1)
    assert "In(parameter" in pushed and "IsNotNull(value)" in pushed and "IsNotNull(city)" in pushed
    assert not exchanges(text)


def test_statistics_read_only_their_columns(spark, facts):
    text = plan(an.hourly_stats(an.prepare(facts, AIR_QUALITY), AIR_QUALITY))
    schema = re.search(r"ReadSchema: struct<(.*)>", text).group(1)
    assert "unit" not in schema and "source" not in schema
    assert len(exchanges(text)) == 1 and "partial_avg" in text


def test_exact_bounds_reach_the_scan(spark, facts):
    text = plan(quantiles.trim_band(facts, "value", relative_error=0.0))
    pushed = re.search(r"PushedFilters: \[(.*)\]", text).group(1)
    assert "GreaterThanOrEqual(value,0.0)" in pushed and "LessThanOrEqual(value,8.0)" in pushed


def test_dedup_combines_before_its_only_shuffle(spark, facts):
    text = plan(refine.distinct_rows(facts))
    assert len(exchanges(text)) == 1 and text.count("HashAggregate") >= 4


def test_scratch_is_the_shared_folder(spark):
    assert scratch_root(spark) == spark.conf.get("spark.checkpoint.dir")


@pytest.mark.parametrize("name", [
    "anomalies_weather", "payload_explode", "slugify_documents", "contract_violations",
    "serve_date_range", "quartile_stats_sketch"])
def test_no_python_in_any_plan(spark, name):
    text = plan(QUERIES[name](spark, SF_DIR))
    assert "Python" not in text and "Arrow" not in text and "CartesianProduct" not in text
    assert "BroadcastNestedLoopJoin" not in text
