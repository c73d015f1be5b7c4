"""City subsets by state and first letter."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed value: one part of a range list, such as SP{A-H}.
RANGE_PART = r"([A-Z]{2})\{([A-Z])-([A-Z])\}"


def letter_ranges(spec: str) -> list[tuple[str, str, str]]:
    """(state, first, last) of a list such as ``SP{A-H},RJ{D-F}``.

    Unreadable parts are skipped and a repeated state takes its last range.
    """
    last = {found[0]: found for part in spec.split(",") for found in re.findall(f"^{RANGE_PART}", part)}
    return list(last.values())


def in_letter_ranges(key: Column, spec: str) -> Column:
    """Whether a ``UF-Name`` key has a listed state and initial.

    Initials are compared by code point, so an accented one is in no range of letters;
    an empty list selects nothing.
    """
    parts = F.split(key, "-", 2)
    state, initial = F.get(parts, F.lit(0)), F.upper(F.substring(F.get(parts, F.lit(1)), 1, 1))
    selected = F.lit(False)
    for code, first, last in letter_ranges(spec):
        selected = selected | ((state == code) & initial.between(first, last))
    return selected


def cities_in_ranges(cities: DataFrame, spec: str) -> DataFrame:
    """The cities that a range list selects."""
    return cities.filter(in_letter_ranges(F.col("city"), spec))
