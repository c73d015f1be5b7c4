"""Quantiles and trims, including the sliced path for large groups."""

from __future__ import annotations

import math
import random
import struct
from pathlib import Path

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from pyspark.sql import types as T

from skygauge.operators import quantiles as q
from skygauge.operators import refinement
from skygauge.operators.ranks import count_copies
from skygauge.operators.refinement import order_key, refined_quantiles
from skygauge.session import materialize
from tests.conftest import rows

SHARES = {"Q1": 0.25, "Q3": 0.75, "low": 0.0, "high": 1.0}


def disc(values, share):
    ordered = sorted(values)
    return ordered[max(math.ceil(share * len(ordered)), 1) - 1]


def skewed(n=3000):
    """One group with most rows, a third of all rows one repeated reading."""
    rng = random.Random(7)
    data = [("hot", 4.25)] * (n // 3)
    data += [("hot", round(rng.gauss(10, 5), 3)) for _ in range(n // 2)]
    data += [(rng.choice("abc"), round(rng.uniform(-3, 3), 2)) for _ in range(n // 6)]
    return data


def expected(data):
    groups = {}
    for g, v in data:
        groups.setdefault(g, []).append(v)
    return sorted(((g, *(disc(vs, s) for s in SHARES.values())) for g, vs in groups.items()), key=repr)


@pytest.mark.parametrize("one_slice_rows", [None, 0])
def test_exact_quantiles_match_definition(spark, one_slice_rows):
    data = skewed()
    df = spark.createDataFrame(data, "g string, v double").repartition(8)
    counted = materialize(count_copies(df, ["g", "v"]), "test")
    found = q.counted_quantiles(counted.table, counted.rows, ["g"], "v", SHARES, one_slice_rows)
    assert rows(found, "g", *SHARES) == expected(data)


@pytest.mark.parametrize("one_slice_rows", [None, 0])
def test_whole_column(spark, one_slice_rows):
    data = skewed()
    df = spark.createDataFrame(data, "g string, v double")
    counted = materialize(count_copies(df, ["v"]), "test")
    found = q.counted_quantiles(counted.table, counted.rows, [], "v", SHARES, one_slice_rows)
    assert rows(found) == [tuple(disc([v for _, v in data], s) for s in SHARES.values())]


def test_groups_with_null_key_are_left_out(spark):
    df = spark.createDataFrame([(None, 1.0), ("a", 2.0), ("a", None)], "g string, v double")
    assert rows(q.quartiles(df, ["g"], "v")) == [("a", 2.0, 2.0)]


def test_sketch_is_close_on_large_groups(spark):
    df = spark.range(0, 400_000, 1, 8).select(
        F.pmod("id", F.lit(2)).alias("g"), (F.pmod(F.col("id") * 7919, F.lit(400_009))).cast("double").alias("v"))
    for row in q.quartiles(df, ["g"], "v", method="sketch").collect():
        assert abs(row.Q1 / 400_009 - 0.25) < 0.01 and abs(row.Q3 / 400_009 - 0.75) < 0.01


NUMBERS = st.lists(
    st.one_of(st.none(), st.just(float("nan")), st.floats(-1e6, 1e6, width=32)),
    min_size=1, max_size=60)


@settings(max_examples=8, deadline=None, derandomize=True, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(NUMBERS)
def test_default_trim_only_drops_null_and_nan(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "v double").coalesce(1)
    real = sorted(v + 0.0 for v in values if v is not None and not math.isnan(v))
    assert sorted(r.v for r in q.trim_band(df, "v").collect()) == real


@settings(max_examples=8, deadline=None, derandomize=True, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(NUMBERS)
def test_exact_trim_is_the_quantile_band(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "v double").coalesce(1)
    real = sorted(v for v in values if v is not None and not math.isnan(v))
    band = [v for v in real if disc(real, 0.05) <= v <= disc(real, 0.95)]
    assert sorted(r.v for r in q.trim_band(df, "v", relative_error=0.0).collect()) == band


def test_default_trim_equals_summary_with_that_error(spark):
    """The summary's own bounds at this error are the minimum and the maximum."""
    df = spark.range(1, 5001).select(F.sqrt("id").alias("v"))
    assert df.approxQuantile("v", [0.05, 0.95], 0.05) == [1.0, math.sqrt(5000)]
    assert q.trim_band(df, "v").count() == 5000


def test_intermediate_error_uses_a_summary(spark):
    df = spark.range(1, 10_001).select(F.col("id").cast("double").alias("v"))
    kept = q.trim_band(df, "v", relative_error=0.01).count()
    assert 8_700 <= kept <= 9_300


def test_rank_shares_count_readings_below_and_up_to(spark):
    values = [None, float("nan"), 1.0, 1.0, 2.0, 4.0]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    spans = [tuple(r) for r in q.rank_shares(df, "v", [1.0, 3.0, 4.0]).collect()]
    assert spans == [(1.0, 0.0, 0.5), (3.0, 0.75, 0.75), (4.0, 0.75, 1.0)]
    assert [tuple(r) for r in q.rank_shares(df.limit(0), "v", [1.0]).collect()] == [(1.0, None, None)]
    assert q.rank_shares(df, "v", []).collect() == []


def test_summary_keeps_to_its_rank_error(spark):
    df = spark.range(1, 20_001).select((F.col("id") * 7919 % 20_011).cast("double").alias("v")).repartition(7)
    shares = [0.05, 0.25, 0.5, 0.95]
    for error in (0.001, 0.01, 0.1):
        found = q.global_quantiles(df, "v", shares, error)
        for share, r in zip(shares, q.rank_shares(df, "v", found).collect(), strict=True):
            assert r["below"] <= share + error and r["up_to"] >= share - error


def test_one_sided_band(spark):
    df = spark.range(1, 101).select(F.col("id").cast("double").alias("v"))
    kept = [r.v for r in q.trim_band(df, "v", lower=0.0, upper=0.9, relative_error=0.0).collect()]
    assert (min(kept), max(kept)) == (1.0, 90.0)


def test_infinity_stays_in_the_band(spark):
    df = spark.createDataFrame([(1.0,), (float("inf"),), (float("nan"),), (None,)], "v double")
    assert sorted(r.v for r in q.trim_band(df, "v").collect()) == [1.0, float("inf")]


# --- narrowing ranges ----------------------------------------------------------

ODD = [0.0, -0.0, 5e-324, -5e-324, 2.2250738585072014e-308, 2.225073858507201e-308, 1.0, 1.0000000000000002,
       0.9999999999999999, -1.0, 1e308, -1e308, 1.7976931348623157e308, float("inf"), float("-inf"), 3.0, 8.0,
       7.999999999999999, 1e-300, 0.1, 1 / 3, float("nan")]


def test_order_keys_count_the_doubles_between(spark):
    df = spark.createDataFrame([(v,) for v in ODD], "v double")
    found = {repr(r.v): r.k for r in df.select("v", order_key(F.col("v"), T.DoubleType()).alias("k")).collect()}

    def bits(v):
        number = struct.unpack("<q", struct.pack("<d", abs(v)))[0]
        return -number if v < 0 else number

    for v in ODD:
        assert found[repr(v)] == (bits(float("inf")) + 1 if math.isnan(v) else bits(v)), v


@pytest.mark.parametrize("bits", [2, 12])
def test_refined_quantiles_match_definition(spark, bits):
    data = skewed() + [("odd", v) for v in ODD if not math.isnan(v)] + [("one", 2.5), ("two", -1.0), ("two", -1.5)]
    df = spark.createDataFrame(data, "g string, v double").repartition(5)
    found = refined_quantiles(df, ["g"], "v", SHARES, bits)
    assert rows(found, "g", *SHARES) == expected([(g, v + 0.0) for g, v in data])


@settings(max_examples=3, deadline=None, derandomize=True, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.floats(allow_nan=False), min_size=1, max_size=40))
def test_refined_quantiles_of_any_doubles(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "v double").coalesce(1)
    found = refined_quantiles(df, [], "v", {"m": 0.5, "q": 0.9}).first()
    real = [v + 0.0 for v in values]
    assert (found.m, found.q) == (disc(real, 0.5), disc(real, 0.9))


def test_refined_quantiles_of_other_kinds_and_empty_groups(spark):
    whole = spark.range(1, 1001).select(F.lit(1).alias("a"), F.lit("x").alias("b"), (F.col("id") - 500).alias("v"))
    assert rows(refined_quantiles(whole, ["a", "b"], "v", {"q": 0.25})) == [(1, "x", -250)]
    ends = spark.createDataFrame([(-(1 << 63),), ((1 << 63) - 1,), (5,), (6,)], "v long")
    assert rows(refined_quantiles(ends, [], "v", {"q": 0.5, "r": 0.75})) == [(5, 6)]
    floats = spark.createDataFrame([(0.1,), (0.2,), (0.3,)], "v float")
    assert refined_quantiles(floats, [], "v", {"q": 0.5}).first()[0] == pytest.approx(0.2, rel=1e-6)
    gaps = spark.createDataFrame([(None, 1.0), ("a", None), ("b", 2.0), ("b", None)], "g string, v double")
    assert rows(refined_quantiles(gaps, ["g"], "v", {"q": 0.5})) == [("b", 2.0)]
    assert refined_quantiles(gaps.limit(0), ["g"], "v", {"q": 0.5}).count() == 0
    assert refined_quantiles(gaps.limit(0), [], "v", {"q": 0.5}).first()[0] is None
    with pytest.raises(TypeError):
        refined_quantiles(spark.sql("SELECT 1.5 AS v"), [], "v", {"q": 0.5})


def test_refinement_stores_nothing_that_grows_with_the_readings(spark, monkeypatch):
    stored, keep = [], refinement.materialize

    def noted(*args, **measures):
        stored.append(keep(*args, **measures))
        return stored[-1]

    monkeypatch.setattr(refinement, "materialize", noted)
    df = spark.range(0, 300_000, 1, 8).select((F.col("id") % 3).alias("g"), F.sin("id").alias("v"))
    refined = refined_quantiles(df, ["g"], "v", q.QUARTILES)
    assert rows(refined) == rows(q.exact_quantiles(df, ["g"], "v", q.QUARTILES))
    assert {s.rows for s in stored} == {6} and len(stored) <= 1 + 6
    assert not any(Path(s.path).exists() for s in stored[:-1])


def test_approximate_quantiles_are_exact_in_small_groups(spark):
    df = spark.createDataFrame([(g, v) for g, v in skewed() if g != "hot"], "g string, v double")
    found = q.quartiles(df, ["g"], "v", method="approximate")
    assert rows(found) == rows(q.quartiles(df, ["g"], "v"))
