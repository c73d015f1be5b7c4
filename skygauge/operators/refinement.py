"""Exact quantiles by narrowing ranges of values, for readings that hardly ever repeat.

Every pass counts, for each group and wanted rank, the readings by parts of the range in
which the rank lies, and goes on in the part that holds it.  A part is a power of two of
numbers that rise with the value, so a range of doubles is narrowed to one value in six
passes at most, whatever the values and their number; three are usual.  What is shuffled
and stored are counts, at most ``1 << BITS`` by group and range: nothing grows with the
readings.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from skygauge.operators.joins import lookup_join, total_bytes
from skygauge.session import Stored, materialize

#: A pass cuts a range into twice as many parts as these bits tell, at most.
BITS = 12
_MANTISSA, _LEAST = 52, -1022


def order_key(value: Column, kind: T.DataType) -> Column:
    """A whole number for each value that rises with it: equal for equal values only.

    That of a double counts the doubles between zero and it; NaN follows infinity.
    """
    if isinstance(kind, T.IntegralType):
        return value.cast("long")
    x = value.cast("double")
    size = F.abs(x)
    # The logarithm may be rounded to the wrong side of a power of two.
    near = F.greatest(F.floor(F.log2(size)).cast("int"), F.lit(_LEAST))
    power = F.when(F.pow(F.lit(2.0), near) > size, near - 1).when(
        F.pow(F.lit(2.0), near + 1) <= size, near + 1).otherwise(near)
    power = F.greatest(power, F.lit(_LEAST))
    whole = F.lit(1 << _MANTISSA)
    normal = (power - _LEAST + 1).cast("long") * whole + (
        (size / F.pow(F.lit(2.0), power) - 1) * whole.cast("double")).cast("long")
    # Below the least power a double has no hidden first bit.
    small = (size * F.lit(2.0 ** 537) * F.lit(2.0 ** 537)).cast("long")
    infinite = F.lit((1024 - _LEAST + 1) << _MANTISSA)
    number = (F.when(F.isnan(x), infinite + 1).when(size == F.lit(float("inf")), infinite)
              .when(size < F.lit(2.0 ** _LEAST), small).otherwise(normal))
    return F.when(x < 0, -number).otherwise(number)


def _shift(low: Column, high: Column, bits: int) -> Column:
    """Bits that a part of the range leaves open.

    The whole range may be wider than a long, so its width is estimated as a double.
    """
    width = F.ceil(F.log2(high.cast("double") - low.cast("double") + 1)).cast("int")
    return F.greatest(width - bits, F.lit(0))


def refined_quantiles(
    df: DataFrame, group: Sequence[str], value: str, shares: Mapping[str, float], bits: int = BITS
) -> DataFrame:
    """One row per group with each named quantile: the observed value of its rank.

    ``df`` is read once for each pass; keep it where that is dear.  NULL readings and
    groups with a NULL key are left out; -0.0 is 0.0.
    """
    group, kind = list(group), df.schema[value].dataType
    if not isinstance(kind, (T.IntegralType, T.DoubleType, T.FloatType)):
        raise TypeError(f"{value} is no column of whole numbers or floats")
    facts = df.select(*group, value).filter(F.col(value).isNotNull())
    for key in group:
        facts = facts.filter(F.col(key).isNotNull())
    if not isinstance(kind, T.IntegralType):
        facts = facts.withColumn(value, F.col(value) + F.lit(0.0).cast(kind))
    facts = facts.withColumnRenamed(value, "_v")

    spans = facts.groupBy(*group).agg(F.count("_v").alias("_n"), F.min("_v").alias("_least"), F.max("_v").alias("_most"))
    if not group:
        spans = spans.filter("_n > 0")
    ranks = F.array(*[F.struct(
        F.lit(name).alias("_name"), F.greatest(F.ceil(F.lit(s) * F.col("_n")), F.lit(1)).alias("_rank"))
        for name, s in shares.items()])
    state = _kept(spans.select(*group, F.inline(ranks), "_least", "_most"))
    while state.measures["open"]:
        narrower = _kept(_narrowed(facts, state, group, kind, bits))
        state.release()
        state = narrower
    return state.table.groupBy(*group).agg(*[
        F.max(F.when(F.col("_name") == name, F.col("_least"))).alias(name) for name in shares])


def _kept(state: DataFrame) -> Stored:
    apart = ~F.col("_least").eqNullSafe(F.col("_most"))
    return materialize(state, "ranges", size=total_bytes(state), open=F.count_if(apart))


def _narrowed(facts: DataFrame, state: Stored, group: list[str], kind: T.DataType, bits: int) -> DataFrame:
    """The state after one pass: ranges that are one value stay, others become one of their parts."""
    table = state.table
    settled = table.filter(F.col("_least").eqNullSafe(F.col("_most")))
    low, high = order_key(F.col("_least"), kind), order_key(F.col("_most"), kind)
    ranges = table.filter(~F.col("_least").eqNullSafe(F.col("_most"))).withColumns(
        {"_low": low, "_shift": _shift(low, high, bits)})
    # Ranks in one range have it in common; ranges of a group do not overlap.
    sought = ranges.select(*group, "_least", "_most", "_low", "_shift").distinct()
    inside = (F.col("_v") >= F.col("_least")) & (F.col("_v") <= F.col("_most"))
    if group:
        met = lookup_join(facts, sought, group, state.measures["size"]).filter(inside)
    else:
        met = facts.join(F.broadcast(sought), inside)
    part = F.call_function("shiftright", order_key(F.col("_v"), kind), F.col("_shift")) - F.call_function(
        "shiftright", F.col("_low"), F.col("_shift"))
    counts = met.groupBy(*group, F.col("_low").alias("_from"), part.alias("_part")).agg(
        F.count("_v").alias("_c"), F.min("_v").alias("_first"), F.max("_v").alias("_last"))
    keyed = [counts[g].alias(f"_g{i}") for i, g in enumerate(group)]
    counts = counts.select(*keyed, "_from", "_part", "_c", "_first", "_last")
    same = F.col("_low") == F.col("_from")
    for i, g in enumerate(group):
        same = same & (F.col(g) == F.col(f"_g{i}"))
    upto = F.sum("_c").over(Window.partitionBy(*group, "_name").orderBy("_part"))
    placed = ranges.join(counts, same).withColumn("_upto", upto)
    before = F.col("_upto") - F.col("_c")
    holds = placed.filter((before < F.col("_rank")) & (F.col("_rank") <= F.col("_upto")))
    return settled.unionByName(holds.select(
        *group, "_name", (F.col("_rank") - before).alias("_rank"), F.col("_first").alias("_least"),
        F.col("_last").alias("_most")))
