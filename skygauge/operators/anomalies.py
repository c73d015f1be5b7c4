"""The anomaly kernel: hour-of-day z-score and interquartile range."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from skygauge.functions.scoring import iqr_outlier, severity, z_score
from skygauge.functions.times import event_time
from skygauge.operators.joins import lookup_join, total_bytes
from skygauge.operators.quantiles import (
    QUARTILES,
    SKETCH_PARTS,
    SKETCH_SIZE,
    counted_quantiles,
    quartiles,
    read_sketches,
    trim_band,
)
from skygauge.operators.ranks import WEIGHT
from skygauge.operators.refine import distinct_rows
from skygauge.session import materialize

# The air-quality parameters that are scored.
SCORED_PARAMETERS = ["pm25", "pm10", "no2", "o3", "co", "so2"]

# Fixed value: z-score above which a reading is an anomaly.
ANOMALY_Z = 2.0


@dataclass(frozen=True)
class Readings:
    """Column names of one kind of fact, and which of its parameters count."""

    value: str
    keys: tuple[str, ...]
    time: str
    mean: str
    spread: str
    score: str
    parameters: tuple[str, ...] | None = None


WEATHER = Readings(
    value="temperature", keys=("city",), time="time",
    mean="avg_temp", spread="std_temp", score="temp_z_score",
)

AIR_QUALITY = Readings(
    value="value", keys=("city", "parameter"), time="timestamp",
    mean="avg_value", spread="std_value", score="aqi_z_score",
    parameters=tuple(SCORED_PARAMETERS),
)


def pollutant_filter(df: DataFrame, parameters: Sequence[str] = SCORED_PARAMETERS) -> DataFrame:
    """Keep the named parameters."""
    return df.filter(F.col("parameter").isin(list(parameters)))


def with_hour(df: DataFrame, kind: Readings) -> DataFrame:
    """Add the parsed ``timestamp`` and its hour of day."""
    when = F.col(kind.time)
    text = isinstance(df.schema[kind.time].dataType, T.StringType)
    moment = event_time(when) if text else F.try_to_timestamp(when)
    return df.withColumn("timestamp", moment).withColumn("hour", F.hour("timestamp"))


def hourly_stats(df: DataFrame, kind: Readings) -> DataFrame:
    """Mean and sample deviation by entity and hour of day."""
    return df.groupBy(*kind.keys, "hour").agg(
        F.avg(kind.value).alias(kind.mean),
        F.stddev_samp(kind.value).alias(kind.spread),
    )


def prepare(
    df: DataFrame,
    kind: Readings,
    relative_error: float = 0.05,
    dedup_first: bool = False,
    drop_nonfinite: bool = False,
) -> DataFrame:
    """Readings that take part: known parameter, key, hour, value in the band.

    ``dedup_first`` removes repeated rows before they weigh on the statistics;
    ``drop_nonfinite`` removes infinities, which otherwise spoil their group.
    """
    facts = pollutant_filter(df, kind.parameters) if kind.parameters else df
    if dedup_first:
        facts = distinct_rows(facts)
    facts = with_hour(facts, kind)
    if drop_nonfinite:
        facts = facts.filter(F.abs(F.col(kind.value)) < F.lit(float("inf")))
    facts = trim_band(facts, kind.value, relative_error=relative_error)
    for key in (*kind.keys, "hour"):
        facts = facts.filter(F.col(key).isNotNull())
    return facts


@dataclass(frozen=True)
class Baseline:
    """Statistics of every entity and hour of day, with their measured size."""

    table: DataFrame
    size: int


def baseline(facts: DataFrame, kind: Readings, method: str = "exact") -> Baseline:
    """Hourly statistics joined with quartiles: one row per entity and hour.

    What is derived from the facts is stored, so scoring does not repeat it.
    ``method`` chooses the quartiles, see ``quantiles.quartiles``.
    """
    keys = list(kind.keys)
    if method == "exact":
        return _baseline_in_one_scan(facts, kind)
    if method == "sketch":
        return _baseline_of_sketches(facts, kind)
    table = hourly_stats(facts, kind).join(quartiles(facts, keys, kind.value, method), keys)
    stored = materialize(table, "baseline", size=total_bytes(table))
    return Baseline(stored.table, stored.measures["size"])


def _baseline_in_one_scan(facts: DataFrame, kind: Readings) -> Baseline:
    """Two grouping sets share one scan and one shuffle of partial aggregates:
    by hour for the moments, by value for the counts that quartiles come from."""
    keys, by_hour = list(kind.keys), F.col("hour").isNotNull()
    grouped = facts.select(*keys, "hour", kind.value).groupingSets(
        [[*keys, "hour"], [*keys, kind.value]], *keys, "hour", kind.value
    ).agg(
        F.avg(kind.value).alias(kind.mean),
        F.stddev_samp(kind.value).alias(kind.spread),
        F.count(F.lit(1)).alias(WEIGHT),
    )
    stored = materialize(grouped, "grouped", size=total_bytes(grouped, by_hour))
    hourly = stored.table.filter(by_hour).select(*keys, "hour", kind.mean, kind.spread)
    counted = stored.table.filter(~by_hour).select(*keys, kind.value, WEIGHT)
    entity = counted_quantiles(counted, stored.rows, keys, kind.value, QUARTILES)
    return Baseline(hourly.join(entity, keys), stored.measures["size"])


def _baseline_of_sketches(facts: DataFrame, kind: Readings) -> Baseline:
    """One grouped pass keeps moments and a sketch by hour; those of an entity's hours are merged.

    Parts of the scan are summarised first, so a hot city does not meet in one task: at
    most ``SKETCH_PARTS`` summaries of an hour are.
    """
    keys = list(kind.keys)
    part = F.pmod(F.spark_partition_id(), F.lit(SKETCH_PARTS)).alias("_part")
    parts = facts.groupBy(*keys, "hour", part).agg(
        F.count(kind.value).alias("n"), F.avg(kind.value).alias("m"), F.var_pop(kind.value).alias("v"),
        F.kll_sketch_agg_double(F.col(kind.value).cast("double"), SKETCH_SIZE).alias("_sketch"))
    hours = parts.groupBy(*keys, "hour").agg(
        F.sum("n").alias("_n"), F.collect_list(F.struct("n", "m", "v")).alias("_parts"),
        F.kll_merge_agg_double("_sketch", SKETCH_SIZE).alias("_sketch"))
    mean = F.aggregate("_parts", F.lit(0.0), lambda total, p: total + p["n"] * p["m"]) / F.col("_n")
    squares = F.aggregate("_parts", F.lit(0.0), lambda total, p: total + p["n"] * (
        p["v"] + (p["m"] - F.col(kind.mean)) * (p["m"] - F.col(kind.mean))))
    grouped = hours.withColumn(kind.mean, mean).withColumn(
        kind.spread, F.when(F.col("_n") > 1, F.sqrt(squares / (F.col("_n") - 1)))
    ).select(*keys, "hour", kind.mean, kind.spread, "_sketch")
    flat = grouped.drop("_sketch")
    stored = materialize(grouped, "sketched", size=total_bytes(flat))
    merged = stored.table.groupBy(*keys).agg(F.kll_merge_agg_double("_sketch", SKETCH_SIZE).alias("_sketch"))
    # Kept once: merging draws again at each reading.
    entity = materialize(read_sketches(merged, keys, QUARTILES), "quartiles").table
    return Baseline(stored.table.drop("_sketch").join(entity, keys), stored.measures["size"])


def score(facts: DataFrame, against: Baseline, kind: Readings,
          limit: int | None = None) -> DataFrame:
    """Add statistics, z-score, severity, quartiles and the IQR flag to facts."""
    x, q1, q3 = F.col(kind.value), F.col("Q1"), F.col("Q3")
    return (
        lookup_join(facts, against.table, [*kind.keys, "hour"], against.size, limit)
        .withColumn(kind.score, z_score(x, F.col(kind.mean), F.col(kind.spread)))
        .withColumn("anomaly_level", severity(F.col(kind.score)))
        .withColumn("IQR", q3 - q1)
        .withColumn("is_iqr_anomaly", iqr_outlier(x, q1, q3))
    )


def only_anomalies(scored: DataFrame, kind: Readings) -> DataFrame:
    """Rows with a high z-score or an IQR flag; NULL OR false drops."""
    return scored.filter((F.col(kind.score) > ANOMALY_Z) | F.col("is_iqr_anomaly"))


def detect_anomalies(
    df: DataFrame,
    kind: Readings,
    relative_error: float = 0.05,
    method: str = "exact",
    dedup_first: bool = False,
    drop_nonfinite: bool = False,
) -> DataFrame:
    """Anomalous readings of ``df`` against the baseline of ``df`` itself.

    The statistics are aggregated and stored first; the facts are then scored
    while they stream past the broadcast lookup, without a shuffle.
    """
    facts = prepare(df, kind, relative_error, dedup_first, drop_nonfinite)
    if dedup_first:
        # The copies are dropped by one shuffle of the facts, not again by the scoring.
        facts = materialize(facts, "distinct").table
    return only_anomalies(score(facts, baseline(facts, kind, method), kind), kind)
