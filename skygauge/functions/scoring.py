"""Scores of one reading against its group's baseline."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Severity names with the z-scores they start above.
SEVERITY_STEPS = {"extrema": 3.0, "severa": 2.5, "moderada": 2.0}

# Fixed value: fence width in interquartile ranges.
FENCE = 1.5


def z_score(x: Column, mean: Column, spread: Column) -> Column:
    """Absolute distance from the mean in standard deviations.

    NULL for a group of one row (no deviation) and for a constant group.
    """
    return F.abs(F.try_divide(x - mean, spread))


def severity(z: Column) -> Column:
    """Name of the highest step that ``z`` lies strictly above, else NULL."""
    return F.coalesce(*[
        F.when(z > floor, F.lit(name))
        for name, floor in sorted(SEVERITY_STEPS.items(), key=lambda s: -s[1])
    ])


def iqr_outlier(x: Column, q1: Column, q3: Column, fence: float = FENCE) -> Column:
    """Whether ``x`` lies strictly outside the interquartile fences."""
    reach = F.lit(fence) * (q3 - q1)
    return (x < q1 - reach) | (x > q3 + reach)
