"""Time expressions: lenient parsing, day bounds, partition dates."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column
from pyspark.sql import functions as F

# Display date and file-name time formats.
DISPLAY_DATE = "dd-MM-yyyy"
FILE_TIME = "yyyyMMdd-HHmmss"
FILE_TIME_PATTERN = r"/(\d{8}-\d{6})\.json$"

_CLOCK_ONLY = r"^\s*T?\d{1,2}:"


def event_time(when: Column) -> Column:
    """Timestamp of a string or timestamp column; NULL where it cannot be read.

    A time of day without a date is not read: it would mean another day at each run.
    """
    return F.when(~when.cast("string").rlike(_CLOCK_ONLY), F.try_to_timestamp(when))


def _iso(text: Column) -> Column:
    """ISO text of a compact date, with its time of day if there is one; other text as it is."""
    day = F.regexp_replace(text, r"^(\d{4})(\d{2})(\d{2})(?=$|[T ])", "$1-$2-$3")
    minutes = F.regexp_replace(day, r"^(\S{10}[T ]\d{2})(\d{2})(?=$|\d{2}$)", "$1:$2")
    return F.regexp_replace(minutes, r"^(\S{10}[T ]\d{2}:\d{2})(\d{2})$", "$1:$2")


def _numeric(text: Column, order: str) -> Column:
    """ISO text of a date written as two numbers and a year, which ``order`` arranges."""
    return F.regexp_replace(text, r"^(\d{2})-(\d{2})-(\d{4})(?=$|[T ])", order)


def landing_time(when: Column, ingested: Column) -> Column:
    """Wall-clock event time of a message, or its ingestion time if unreadable.

    Read are ISO, then ``yyyyMMdd``, then ``MM-dd-yyyy``, then ``dd-MM-yyyy``, each
    with or without a time of day.  A bare time of day is unreadable.
    """
    text = when.cast("string")
    return F.coalesce(
        event_time(when),
        event_time(_iso(text)),
        event_time(_numeric(text, "$3-$1-$2")),
        event_time(_numeric(text, "$3-$2-$1")),
        ingested,
    ).cast("timestamp_ntz")


def file_name_time(path: Column) -> Column:
    """Ingestion time that a stored message's file name carries, else NULL."""
    return F.try_to_timestamp(
        F.regexp_extract(path, FILE_TIME_PATTERN, 1), F.lit(FILE_TIME)
    )


def partition_dates(when: Column) -> dict[str, Column]:
    """Partition columns of a day: year, zero-padded month and day."""
    return {
        "year": F.year(when),
        "month": F.date_format(when, "MM"),
        "day": F.date_format(when, "dd"),
    }


def to_day(text: Column) -> Column:
    """Midnight of a date written as ISO, ``yyyyMMdd`` or ``dd-MM-yyyy``.

    The time of day and any offset are dropped, not converted.
    """
    day = F.regexp_extract(_iso(text), r"^(\d{4}-\d{2}-\d{2})(?:[T ].*)?$", 1)
    return F.coalesce(
        F.when(event_time(_iso(text)).isNotNull(), F.try_to_date(day, "yyyy-MM-dd")),
        F.try_to_date(text, DISPLAY_DATE),
    ).cast("timestamp_ntz")


def day_bound(text: str, truncate: bool = True) -> datetime:
    """The same rule for one bound given by a caller; ValueError if unreadable."""
    try:
        moment = datetime.fromisoformat(text)
    except ValueError:
        moment = datetime.strptime(text, "%d-%m-%Y")
    moment = moment.replace(tzinfo=None)
    return moment.replace(hour=0, minute=0, second=0, microsecond=0) if truncate else moment


def date_string(when: Column, form: str = "") -> Column:
    """Text of a day: ``display``, ``iso_date_only`` or ISO at midnight."""
    patterns = {"display": DISPLAY_DATE, "iso_date_only": "yyyy-MM-dd"}
    return F.date_format(when, patterns.get(form, "yyyy-MM-dd'T00:00:00'"))


def time_string(when: Column) -> Column:
    """Display text of a moment, which is its date."""
    return F.date_format(when, DISPLAY_DATE)
