"""Joins of a large fact table with a lookup whose size has been measured."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: A lookup up to this size is copied to every executor.
BROADCAST_BYTES = 64 * 1024 * 1024

_ROW_OVERHEAD = 16


def row_bytes(df: DataFrame) -> Column:
    """Size of one row of a flat table, text counted at its length."""
    width = F.lit(_ROW_OVERHEAD + 8 * len(df.columns)).cast("long")
    for field in df.schema.fields:
        if isinstance(field.dataType, T.StringType):
            width = width + F.coalesce(F.octet_length(field.name), F.lit(0))
    return width


def total_bytes(df: DataFrame, where: Column | None = None) -> Column:
    """Aggregate: bytes of all rows, or of those that satisfy ``where``."""
    size = row_bytes(df) if where is None else F.when(where, row_bytes(df))
    return F.coalesce(F.sum(size), F.lit(0))


def lookup_join(
    facts: DataFrame,
    lookup: DataFrame,
    keys: Sequence[str],
    lookup_bytes: int,
    limit: int | None = None,
) -> DataFrame:
    """Inner join of ``facts`` with a ``lookup`` that has one row per key.

    A lookup measured within ``limit`` bytes is broadcast, so the facts are not
    shuffled.  A larger one is left to a shuffled join, where adaptive execution
    splits the partitions of hot keys.
    """
    limit = BROADCAST_BYTES if limit is None else limit
    side = F.broadcast(lookup) if lookup_bytes <= limit else lookup
    return facts.join(side, list(keys))
