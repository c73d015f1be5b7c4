"""Quantiles by group, exact or approximate, and the quantile-band trim."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skygauge.operators.ranks import FIRST, LAST, TOTAL, count_copies, select_ranks
from skygauge.operators.refinement import refined_quantiles
from skygauge.session import materialize

#: Items a sketch keeps; larger is more precise (0.1 % of rank at 4096).
SKETCH_SIZE = 4096

#: Sketches of one group are merged first within this many parts.
SKETCH_PARTS = 64

#: Below this rank error the exact selection is cheaper than a summary.
SMALLEST_ERROR = 1e-4

QUARTILES = {"Q1": 0.25, "Q3": 0.75}


def _rank(share: float, total: Column) -> Column:
    """Rank of a quantile: the smallest that covers ``share`` of the rows."""
    return F.greatest(F.ceil(F.lit(share) * total), F.lit(1))


def exact_quantiles(
    df: DataFrame, group: Sequence[str], value: str, shares: Mapping[str, float]
) -> DataFrame:
    """One row per group with each named quantile, an observed value.

    Readings are counted by value before the shuffle, so the work after the scan
    grows with distinct readings, and no task holds an unbounded group.
    """
    counted = count_copies(df.filter(F.col(value).isNotNull()), [*group, value])
    stored = materialize(counted, "counted")
    return counted_quantiles(stored.table, stored.rows, group, value, shares)


def counted_quantiles(
    counted: DataFrame,
    rows: int,
    group: Sequence[str],
    value: str,
    shares: Mapping[str, float],
    one_slice_rows: int | None = None,
) -> DataFrame:
    """The same from a stored count of at most ``rows`` readings by group and value."""
    picked = select_ranks(
        counted, rows, group, [F.col(value)],
        lambda total: [(_rank(s, total), _rank(s, total)) for s in shares.values()],
        one_slice_rows,
    )
    return picked.groupBy(*group).agg(*[
        F.max(
            F.when(_rank(s, F.col(TOTAL)).between(F.col(FIRST), F.col(LAST)), F.col(value))
        ).alias(name)
        for name, s in shares.items()
    ])


def sketch_quantiles(
    df: DataFrame,
    group: Sequence[str],
    value: str,
    shares: Mapping[str, float],
    size: int = SKETCH_SIZE,
) -> DataFrame:
    """The same from mergeable sketches; exact for groups within ``size`` rows.

    One pass and a shuffle of sketches only.  A group's sketches are merged in
    parts by scan task first, so a hot group does not meet in one task.
    """
    part = F.pmod(F.spark_partition_id(), F.lit(SKETCH_PARTS)).alias("_part")
    sketched = (
        df.filter(F.col(value).isNotNull())
        .groupBy(*group, part)
        .agg(F.kll_sketch_agg_double(value, size).alias("_sketch"))
        .groupBy(*group)
        .agg(F.kll_merge_agg_double("_sketch", size).alias("_sketch"))
    )
    return read_sketches(sketched, group, shares)


def read_sketches(sketched: DataFrame, group: Sequence[str], shares: Mapping[str, float]) -> DataFrame:
    """Each named quantile of the sketches in ``_sketch``."""
    return sketched.select(*group, *[
        F.kll_sketch_get_quantile_double("_sketch", F.lit(s)).alias(name)
        for name, s in shares.items()
    ])


#: Counters of the summary by group; its rank error is one in so many.
ACCURACY = 10_000


def approximate_quantiles(
    df: DataFrame,
    group: Sequence[str],
    value: str,
    shares: Mapping[str, float],
    accuracy: int = ACCURACY,
) -> DataFrame:
    """The same from Spark's summary, without chance: exact for groups within ``accuracy`` rows."""
    return df.filter(F.col(value).isNotNull()).groupBy(*group).agg(*[
        F.percentile_approx(value, s, accuracy).alias(name) for name, s in shares.items()])


METHODS = {
    "exact": exact_quantiles,
    "refine": refined_quantiles,
    "approximate": approximate_quantiles,
    "sketch": sketch_quantiles,
}


def quartiles(df: DataFrame, group: Sequence[str], value: str, method: str = "exact") -> DataFrame:
    """Q1 and Q3 by group.

    ``exact`` counts readings by value; ``refine`` is as exact and never stores a table
    that grows with the readings, at the price of more passes; ``approximate`` and
    ``sketch`` are summaries, the latter one with chance in it.
    """
    return METHODS[method](df, group, value, QUARTILES)


def global_quantiles(
    df: DataFrame, value: str, shares: Sequence[float], relative_error: float
) -> list[float]:
    """Quantiles of a whole column within a rank error; NULL and NaN are ignored.

    Empty for an empty column.  Only these few numbers reach the driver.
    """
    readings = numbers_only(df.select(value), value)
    if relative_error >= SMALLEST_ERROR:
        return readings.approxQuantile(value, list(shares), relative_error)
    names = {f"q{i}": s for i, s in enumerate(shares)}
    found = exact_quantiles(readings, [], value, names).first()
    return [] if found is None or found["q0"] is None else list(found)


def rank_shares(df: DataFrame, value: str, values: Sequence[float]) -> DataFrame:
    """value, below, up_to: the shares of readings less than each value, and of those up to it.

    One pass; NULL and NaN are no readings, and without any both shares are NULL.
    """
    if not values:
        return df.sparkSession.createDataFrame([], "value double, below double, up_to double")

    def share(holds: Column) -> Column:
        return F.try_divide(F.count_if(holds), F.count(F.lit(1)))

    spans = [F.struct(F.lit(float(v)).alias("value"), share(F.col(value) < v).alias("below"),
                      share(F.col(value) <= v).alias("up_to")) for v in values]
    return numbers_only(df, value).agg(F.array(*spans).alias("spans")).select(F.inline("spans"))


def numbers_only(df: DataFrame, value: str) -> DataFrame:
    """Rows whose value is neither NULL nor NaN; infinities stay."""
    return df.filter(F.col(value).isNotNull() & ~F.isnan(value))


def trim_band(
    df: DataFrame,
    value: str,
    lower: float = 0.05,
    upper: float = 0.95,
    relative_error: float = 0.05,
) -> DataFrame:
    """Keep values from the ``lower`` to the ``upper`` quantile, both included.

    A bound within ``relative_error`` of its end of the order may be any value
    up to that end and is taken as the minimum or maximum, so it removes nothing
    and needs no pass over the data.  With the defaults only NULL and NaN go.
    Use ``relative_error=0`` for a true 5 % - 95 % band.
    """
    kept = numbers_only(df, value)
    bounded = [s for s in (lower, upper) if relative_error < s < 1 - relative_error]
    if not bounded:
        return kept
    found = dict(zip(bounded, global_quantiles(df, value, bounded, relative_error)))
    if lower in found:
        kept = kept.filter(F.col(value) >= F.lit(found[lower]))
    if upper in found:
        kept = kept.filter(F.col(value) <= F.lit(found[upper]))
    return kept
