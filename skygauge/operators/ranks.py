"""Distributed selection by rank over weighted, ordered rows.

Exact quantiles and deep pages ask the same question: which rows hold given
ranks in an order?  Equal rows are first counted (combined map-side, so copies
and hot groups shrink before any shuffle).  The counted rows are range
partitioned by group and order, which cuts even one huge group into slices of
bounded size; per-slice totals give each slice's starting rank, and only the
slices that hold a wanted rank are ranked row by row.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from skygauge.operators.joins import lookup_join, total_bytes
from skygauge.session import materialize

#: Up to this many counted rows in all are ranked without slicing.
ONE_SLICE_ROWS = 1_000_000
#: Slices at most; beyond as many times ``ONE_SLICE_ROWS`` rows slices grow.
MOST_SLICES = 20_000

WEIGHT, FIRST, LAST, TOTAL = "_weight", "_first", "_last", "_total"
_SLICE, _ROWS, _BEFORE = "_slice", "_rows", "_before"

#: Maps a group's total to the inclusive rank ranges that are wanted.
RankRanges = Callable[[Column], Sequence[tuple[Column, Column]]]


def count_copies(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Distinct combinations of ``columns`` with their number of rows."""
    return df.groupBy(*columns).agg(F.count(F.lit(1)).alias(WEIGHT))


def _running_sum(column: str, group: Sequence[str], order: Sequence[Column]) -> Column:
    upto = (
        Window.partitionBy(*group)
        .orderBy(*order)
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    return F.sum(column).over(upto)


def _any_overlap(first: Column, last: Column, ranges: Sequence[tuple[Column, Column]]) -> Column:
    overlap = F.lit(False)
    for low, high in ranges:
        overlap = overlap | ((first <= high) & (last >= low))
    return overlap


def select_ranks(
    counted: DataFrame,
    rows: int,
    group: Sequence[str],
    order: Sequence[Column],
    wanted: RankRanges,
    one_slice_rows: int | None = None,
) -> DataFrame:
    """Counted rows that cover a wanted rank of their group.

    ``counted`` is read from a stored table, has at most ``rows`` rows and carries
    multiplicity in ``_weight``.  The result adds the ranks each row covers
    (``_first`` to ``_last``) and the group's ``_total``.  Groups with a NULL key
    are left out.
    """
    group = list(group)
    bound = ONE_SLICE_ROWS if one_slice_rows is None else one_slice_rows
    for key in group:
        counted = counted.filter(F.col(key).isNotNull())

    if rows <= bound:
        placed = counted.withColumn(LAST, _running_sum(WEIGHT, group, order)).withColumn(
            TOTAL, F.sum(WEIGHT).over(Window.partitionBy(*group))
        )
    else:
        # Stored again so that a row's slice number cannot change between uses.
        slices = materialize(
            counted.repartitionByRange(
                min(MOST_SLICES, -(-rows // max(1, bound))), *[F.col(c) for c in group], *order)
            .withColumn(_SLICE, F.spark_partition_id()),
            "sliced",
        ).table
        # One row per group plus one per slice boundary.
        totals = slices.groupBy(*group, _SLICE).agg(F.sum(WEIGHT).alias(_ROWS))
        totals = totals.withColumn(
            _BEFORE, _running_sum(_ROWS, group, [F.col(_SLICE)]) - F.col(_ROWS)
        ).withColumn(TOTAL, F.sum(_ROWS).over(Window.partitionBy(*group)))
        hits = totals.filter(
            _any_overlap(
                F.col(_BEFORE) + 1, F.col(_BEFORE) + F.col(_ROWS), wanted(F.col(TOTAL))
            )
        ).drop(_ROWS)
        hits = materialize(hits, "slices", size=total_bytes(hits))
        keys = [*group, _SLICE]
        placed = (
            lookup_join(slices, hits.table, keys, hits.measures["size"])
            .withColumn(LAST, F.col(_BEFORE) + _running_sum(WEIGHT, keys, order))
            .drop(_SLICE, _BEFORE)
        )

    placed = placed.withColumn(FIRST, F.col(LAST) - F.col(WEIGHT) + 1)
    return placed.filter(_any_overlap(F.col(FIRST), F.col(LAST), wanted(F.col(TOTAL))))
