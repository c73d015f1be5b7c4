"""Ordered pages and the filters of the serving queries."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from skygauge.functions.times import day_bound
from skygauge.operators.ranks import FIRST, LAST, WEIGHT, count_copies, select_ranks
from skygauge.session import materialize, settle

#: A page that ends within this many rows is a bounded top-k in every task.
TOP_K_ROWS = 100_000


def by_time(df: DataFrame, ties: Sequence[str] | None = None) -> DataFrame:
    """Oldest first, missing times last, ties by the other columns."""
    return df.orderBy(*_time_order(df, ties))


def _time_order(df: DataFrame, ties: Sequence[str] | None):
    ties = [c for c in df.columns if c != "timestamp"] if ties is None else ties
    return [F.asc_nulls_last("timestamp"), *[F.asc_nulls_last(c) for c in ties]]


def page(
    df: DataFrame,
    limit: int = 1000,
    offset: int = 0,
    ties: Sequence[str] | None = None,
    top_k_rows: int | None = None,
    one_slice_rows: int | None = None,
) -> DataFrame:
    """Rows ``offset`` to ``offset + limit`` of the time order.

    A page near the start is a top-k.  A deep or large one is found by rank, so
    that no task sorts everything before it: counts by hour narrow the rows to
    the hours that the page touches, and ranks within those pick the page.
    """
    if limit < 0 or offset < 0:
        raise ValueError("limit and offset must not be negative")
    if limit == 0:
        return df.limit(0)
    df = positive_zeros(df)
    end = offset + limit
    if end <= (TOP_K_ROWS if top_k_rows is None else top_k_rows):
        return by_time(df, ties).offset(offset).limit(limit)
    return _ranked_page(df, offset, end, ties, one_slice_rows)


def positive_zeros(df: DataFrame) -> DataFrame:
    """0.0 for -0.0, as grouping makes it, so that every way to a page gives one value."""
    floating = (T.DoubleType, T.FloatType)
    return df.select(*[
        (F.col(f"`{f.name}`") + F.lit(0.0).cast(f.dataType)).alias(f.name)
        if isinstance(f.dataType, floating) else F.col(f"`{f.name}`") for f in df.schema.fields])


def _touched(counted: DataFrame, rows: int, offset: int, end: int):
    """Buckets of the time order that hold ranks ``offset + 1`` to ``end``.

    Returns the first and last such bucket as text (NULL times come last), whether
    NULL is among them, and the rank of the first row in them; None if there are
    no such rows.  Only one small row per bucket is ranked.
    """
    hits = select_ranks(
        counted, rows, [], [F.asc_nulls_last("_bucket")],
        lambda total: [(F.lit(offset + 1), F.lit(end))],
    )
    span = hits.agg(
        F.min("_bucket").cast("string").alias("since"),
        F.max("_bucket").cast("string").alias("until"),
        F.max(F.col("_bucket").isNull()).alias("missing"),
        F.min(FIRST).alias("first"),
    ).first()
    return span if span["first"] is not None else None


def _within(column: str, since: Column | None, until: Column | None, missing: bool) -> Column:
    kept = F.col(column).isNull() if missing else F.lit(False)
    if since is not None:
        kept = kept | ((F.col(column) >= since) & (F.col(column) < until))
    return kept


def days_of_page(df: DataFrame, limit: int, offset: int) -> tuple[DataFrame, int]:
    """Only the day directories of a page, and the offset that remains in them.

    The days are counted from the filter columns alone; a table without
    ``obs_date`` stays as it is.
    """
    if "obs_date" not in df.columns or limit <= 0 or offset < 0:
        return df, offset
    counted = count_copies(df.select(F.col("obs_date").alias("_bucket")), ["_bucket"])
    # The calendar itself bounds the days, so they are ranked without storing them.
    span = _touched(counted, 0, offset, offset + limit)
    if span is None:
        return df.limit(0), 0
    since = until = None
    if span["since"] is not None:
        since = F.lit(span["since"]).cast("date")
        until = F.date_add(F.lit(span["until"]).cast("date"), 1)
    kept = df.filter(_within("obs_date", since, until, span["missing"]))
    return kept, offset - (span["first"] - 1)


def hours_of_page(
    df: DataFrame, index: DataFrame, limit: int, offset: int, date_from: str = "", date_to: str = "",
    uf: str = "", city: str = "",
) -> tuple[DataFrame, int]:
    """Only the hours of a page, and the offset that remains in them, without reading the rows.

    ``df`` is a table stored by day, filtered as the other parameters say, and ``index``
    its rows by hour, state and city (see ``tables.indexed_table``).  The filters hold of
    whole hours, but for the last moment of a range, whose rows the index has apart.
    """
    if limit <= 0 or offset < 0:
        return df, offset
    hours, rows = place(index, uf, city), F.col("rows")
    kind = index.schema["hour"].dataType
    if date_from:
        hours = hours.filter(F.col("hour") >= F.lit(str(day_bound(date_from))).cast(kind))
    if date_to:
        last = F.lit(str(day_bound(date_to))).cast(kind)
        hours = hours.filter(F.col("hour") <= last)
        rows = F.when(F.col("hour") == last, F.col("at_start")).otherwise(rows)
    counted = hours.groupBy(F.col("hour").alias("_bucket")).agg(F.sum(rows).alias(WEIGHT)).filter(F.col(WEIGHT) > 0)
    # The calendar bounds the hours, so they are ranked without storing them.
    span = _touched(counted, 0, offset, offset + limit)
    if span is None:
        return df.limit(0), 0
    since = until = first_day = after = None
    if span["since"] is not None:
        kind = df.schema["timestamp"].dataType
        since, last = F.lit(span["since"]).cast(kind), F.lit(span["until"]).cast(kind)
        until = last + F.expr("INTERVAL 1 HOUR")
        first_day, after = F.to_date(since), F.date_add(F.to_date(last), 1)
    kept = df.filter(_within("obs_date", first_day, after, span["missing"])).filter(
        _within("timestamp", since, until, span["missing"]))
    return kept, offset - (span["first"] - 1)


def _ranked_page(df, offset, end, ties, one_slice_rows):
    """The page's rows are stored, the steps on the way to them are not kept."""
    found = settle(lambda: _ranked_rows(df, offset, end, ties, one_slice_rows), "page")
    return by_time(found.table, ties)


def _ranked_rows(df, offset, end, ties, one_slice_rows):
    hours = df.select(F.date_trunc("hour", "timestamp").alias("_bucket"))
    counted = materialize(count_copies(hours, ["_bucket"]), "hours")
    span = _touched(counted.table, counted.rows, offset, end)
    if span is None:
        return df.limit(0)
    since = until = None
    if span["since"] is not None:
        kind = df.schema["timestamp"].dataType
        since = F.lit(span["since"]).cast(kind)
        until = F.lit(span["until"]).cast(kind) + F.expr("INTERVAL 1 HOUR")
    kept = df.filter(_within("timestamp", since, until, span["missing"]))
    skipped = span["first"] - 1
    low, high = F.lit(offset + 1 - skipped), F.lit(end - skipped)

    counted = materialize(count_copies(kept, df.columns), "counted")
    ranked = select_ranks(
        counted.table, counted.rows, [], _time_order(df, ties), lambda total: [(low, high)],
        one_slice_rows,
    )
    copies = F.least(F.col(LAST), high) - F.greatest(F.col(FIRST), low) + 1
    repeated = ranked.withColumn(WEIGHT, F.explode(F.sequence(F.lit(1), copies)))
    return repeated.select(*df.columns)


def date_range(
    df: DataFrame, date_from: str = "", date_to: str = "", truncate_bounds: bool = True
) -> DataFrame:
    """Times from the start of one day to the start of another, both included.

    Empty text means no bound.  The bound takes the column's own type, so the
    comparison reaches the Parquet reader; with ``truncate_bounds=False`` the
    bounds keep their time of day.  A table stored by day is pruned as well.
    """
    kind = df.schema["timestamp"].dataType
    for text, keep in ((date_from, "ge"), (date_to, "le")):
        if not text:
            continue
        moment = day_bound(text, truncate_bounds)
        bound = F.lit(str(moment)).cast(kind)
        day = F.lit(str(moment.date())).cast("date")
        if keep == "ge":
            df = df.filter(F.col("timestamp") >= bound)
            df = df.filter(F.col("obs_date") >= day) if "obs_date" in df.columns else df
        else:
            df = df.filter(F.col("timestamp") <= bound)
            df = df.filter(F.col("obs_date") <= day) if "obs_date" in df.columns else df
    return df


def place(df: DataFrame, uf: str = "", city: str = "") -> DataFrame:
    """Rows of a state and city, whatever their letter case; empty text means any."""
    for name, wanted in (("uf", uf), ("city", city)):
        if wanted:
            df = df.filter(F.upper(name) == F.upper(F.lit(wanted)))
    return df
