"""Declared schemas of payloads, landed tables and served contracts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

_S, _D, _I = T.StringType(), T.DoubleType(), T.IntegerType()


def _struct(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in fields.items()])


#: One stored weather observation; ``time`` is an ISO string.
WEATHER = _struct(
    city=_S, time=_S, interval=_I, is_day=_I, temperature=_D,
    weathercode=_I, winddirection=_I, windspeed=_D,
)

#: One stored air-quality measurement, long format.
AIR_QUALITY = _struct(
    city=_S, parameter=_S, value=_D, unit=_S,
    timestamp=T.TimestampNTZType(), source=_S,
)

#: The same measurement as a message: the time is still text.
AIR_QUALITY_MESSAGE = _struct(
    city=_S, parameter=_S, value=_D, unit=_S, timestamp=_S, source=_S,
)

#: Raw weather response.
WEATHER_PAYLOAD = _struct(
    current_weather=_struct(
        time=_S, interval=_I, temperature=_D, windspeed=_D,
        winddirection=_I, is_day=_I, weathercode=_I,
    ),
    city=_S,
)

#: Raw air-quality response.
AIR_QUALITY_PAYLOAD = _struct(
    status=_S,
    data=_struct(
        iaqi=T.MapType(_S, _struct(v=_D)),
        time=_struct(s=_S),
    ),
    city=_S,
)

CITIES = _struct(city=_S, lat=_D, long=_D)

#: Coordinates as the city file spells them.
CITY_FILE = T.MapType(_S, _struct(lat=_D, lon=_D))


def lenient(schema: T.StructType) -> T.StructType:
    """The schema to parse JSON with: a whole number may be written as ``90.0``."""
    def widen(kind: T.DataType) -> T.DataType:
        if isinstance(kind, T.StructType):
            return lenient(kind)
        return _D if isinstance(kind, T.IntegerType) else kind
    return T.StructType([T.StructField(f.name, widen(f.dataType)) for f in schema.fields])


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """The schema's columns, numbers in its types; a missing column is NULL.

    Times keep the type they were stored in.
    """
    found = {f.name: f.dataType for f in df.schema.fields}
    columns = []
    for field in schema.fields:
        if field.name not in found:
            column = F.lit(None).cast(field.dataType)
        elif isinstance(field.dataType, T.NumericType):
            column = F.col(field.name).try_cast(field.dataType)
        else:
            column = F.col(field.name)
        columns.append(column.alias(field.name))
    return df.select(*columns)
