"""Served contracts: the columns of each answer and the rules they obey."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skygauge.functions.payloads import AQI_SOURCE, AQI_UNIT
from skygauge.functions.scoring import SEVERITY_STEPS


@dataclass(frozen=True)
class Contract:
    """Columns in order, those that may be NULL, and allowed values."""

    columns: tuple[str, ...]
    nullable: frozenset[str] = frozenset()
    allowed: Mapping[str, tuple[str, ...]] = field(default_factory=dict)


# The served columns.  Coordinates may be missing for a city that
# is not in the dimension, and a z-score for a group without deviation.
WEATHER_CONTRACT = Contract(
    columns=("uf", "city", "timestamp", "interval", "is_day", "temperature",
             "weathercode", "winddirection", "windspeed", "lat", "long"),
    nullable=frozenset({"lat", "long"}),
)
WEATHER_ANOMALY_CONTRACT = Contract(
    columns=("uf", "city", "timestamp", "temperature", "avg_temp", "temp_z_score",
             "anomaly_level", "is_iqr_anomaly", "lat", "long"),
    nullable=frozenset({"temp_z_score", "anomaly_level", "lat", "long"}),
    allowed={"anomaly_level": tuple(SEVERITY_STEPS)},
)
AIR_QUALITY_CONTRACT = Contract(
    columns=("uf", "city", "timestamp", "parameter", "value", "unit", "source",
             "lat", "long"),
    nullable=frozenset({"lat", "long"}),
    allowed={"unit": (AQI_UNIT,), "source": (AQI_SOURCE,)},
)
AIR_QUALITY_ANOMALY_CONTRACT = Contract(
    columns=("uf", "city", "timestamp", "parameter", "value", "unit", "avg_value",
             "std_value", "aqi_z_score", "anomaly_level", "Q1", "Q3", "IQR",
             "is_iqr_anomaly", "lat", "long"),
    nullable=frozenset({"anomaly_level", "lat", "long"}),
    allowed={"anomaly_level": tuple(SEVERITY_STEPS)},
)


def project(df: DataFrame, contract: Contract) -> DataFrame:
    """The contract's columns in order."""
    return df.select(*contract.columns)


def rules(contract: Contract) -> dict[str, Column]:
    """What breaks the contract: reason to condition, neither ever NULL."""
    missing = {
        f"{c} missing": F.col(c).isNull()
        for c in contract.columns if c not in contract.nullable
    }
    outside = {
        f"{c} not allowed": F.col(c).isNotNull() & ~F.col(c).isin(*values)
        for c, values in contract.allowed.items()
    }
    return missing | outside


def violations(contract: Contract) -> Column:
    """Array of the reasons for which a row breaks the contract."""
    return F.array_compact(F.array(*[
        F.when(broken, F.lit(reason)) for reason, broken in rules(contract).items()
    ]))


def check_contract(df: DataFrame, contract: Contract) -> tuple[DataFrame, DataFrame]:
    """Split into (valid rows, quarantined rows with their ``violations``)."""
    broken = reduce(Column.__or__, rules(contract).values())
    quarantined = df.filter(broken).withColumn("violations", violations(contract))
    return df.filter(~broken), quarantined
