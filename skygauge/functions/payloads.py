"""Messages and raw responses: JSON decoding, flattening, exploding."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from skygauge.schemas import WEATHER, conform, lenient

# Constants of every air-quality measurement.
AQI_UNIT = "AQI"
AQI_SOURCE = "WAQI"

_CORRUPT = "_unreadable"


def decode_json(df: DataFrame, column: str, schema: T.StructType, alone: bool = True) -> DataFrame:
    """Replace ``column`` by the fields of its JSON object.

    Rows without exactly one such object stay, with the text in ``_unreadable``
    and NULL fields; see :func:`readable` and :func:`unreadable`.  So do those with a
    fraction, or a number too large, where the schema has a whole number; ``90.0`` is
    one.  Whole numbers inside nested fields stay doubles.  With ``alone=False`` text
    after the object is passed over.
    """
    others = [c for c in df.columns if c != column]
    wrapped = T.StructType([
        T.StructField("_doc", lenient(schema)), T.StructField("_rejected", T.StringType())
    ])
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_rejected"}
    text = F.col("_text")
    # The parser stops after the first value; the two wrappings expose a rest.
    parsed = F.from_json(F.concat(F.lit('{"_doc":'), text, F.lit("}")), wrapped, options)
    good = F.col("_rejected").isNull() & F.col("_doc").isNotNull() & _whole_numbers(F.col("_doc"), schema)
    if alone:
        one = F.json_array_length(F.concat(F.lit("["), text, F.lit("]"))) == 1
        good = F.coalesce(one, F.lit(False)) & good
    return (
        df.select(*others, F.coalesce(F.col(column).cast("string"), F.lit("")).alias("_text"))
        # As a generator the document is parsed once, whatever is later filtered.
        .select(*others, "_text", F.inline(F.array(parsed)))
        .withColumn("_good", good)
        .select(
            *others,
            *[
                F.when(F.col("_good"), _typed(F.col(f"_doc.{f.name}"), f.dataType)).alias(f.name)
                for f in schema.fields
            ],
            F.when(~F.col("_good"), text).alias(_CORRUPT),
        )
    )


def _whole_numbers(fields: Column, schema: T.StructType) -> Column:
    """Whether every whole number of the schema, read as a double, is one and within its type."""
    good = F.lit(True)
    for f in schema.fields:
        field = fields[f.name]
        if isinstance(f.dataType, T.StructType):
            good = good & (field.isNull() | _whole_numbers(field, f.dataType))
        elif isinstance(f.dataType, T.IntegerType):
            fits = field.between(-(2.0 ** 31), 2.0 ** 31 - 1) & (field == F.floor(field))
            good = good & F.coalesce(fits, F.lit(True))
    return good


def _typed(field: Column, kind: T.DataType) -> Column:
    return field.try_cast(kind) if isinstance(kind, T.NumericType) else field


def readable(decoded: DataFrame) -> DataFrame:
    """The decoded rows without the failed ones."""
    return decoded.filter(F.col(_CORRUPT).isNull()).drop(_CORRUPT)


def unreadable(decoded: DataFrame) -> DataFrame:
    """The text of the messages that failed to decode."""
    return decoded.filter(F.col(_CORRUPT).isNotNull()).select(F.col(_CORRUPT).alias("value"))


def encode_json(df: DataFrame) -> DataFrame:
    """One JSON text per row in column ``value``; NULL fields are written out."""
    return df.select(
        F.to_json(F.struct("*"), {"ignoreNullFields": "false"}).alias("value")
    )


def flatten_weather(payloads: DataFrame) -> DataFrame:
    """Observation fields of each weather response, with its city."""
    flat = payloads.filter(F.col("current_weather").isNotNull()).select(
        "city", "current_weather.*"
    )
    return conform(flat, WEATHER)


def ok_status(status: Column) -> Column:
    """Whether a response reports success."""
    return status == "ok"


def explode_pollutants(payloads: DataFrame) -> DataFrame:
    """One measurement per pollutant of each successful response."""
    return (
        payloads.filter(ok_status(F.col("status")))
        .select(
            "city",
            F.col("data.time.s").alias("timestamp"),
            F.explode("data.iaqi").alias("parameter", "_reading"),
        )
        .select(
            "city",
            "parameter",
            F.col("_reading.v").alias("value"),
            F.lit(AQI_UNIT).alias("unit"),
            "timestamp",
            F.lit(AQI_SOURCE).alias("source"),
        )
    )
