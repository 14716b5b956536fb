"""Times of day and event times, kept free of any session time zone."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

TIME_OF_DAY = r"(?:[01][0-9]|2[0-3]):[0-5][0-9](?::[0-5][0-9](?:\.[0-9]{1,9})?)?"
_EPOCH = "TIMESTAMP_NTZ'1970-01-01 00:00:00'"
_MICRO = "INTERVAL '0.000001' SECOND"


def _normal_form(clock: Column) -> Column:
    """Normal form of a valid time; text of the usual length already has it."""
    whole = F.when(F.length(clock) == 5, F.concat(clock, F.lit(":00"))).otherwise(F.substring(clock, 1, 8))
    fraction = F.substring(clock, 10, 9)
    shown = F.concat(
        F.rpad(F.substring(fraction, 1, 3), 3, "0"),
        F.rtrim(F.substring(fraction, 4, 6), F.lit("0")),
    )
    usual = F.length(clock) == len("HH:mm:ss.SSS")
    return F.when(usual, clock).when(clock != "", F.concat(whole, F.lit("."), shown))


def time_of_day(text: Column) -> Column:
    """Normal form of an ISO time of day; NULL when malformed.

    The form is ``HH:mm:ss.`` and at least three fraction digits, without
    trailing zeros past the third, so plain string order is time order.
    """
    return _normal_form(F.regexp_extract(text, f"^{TIME_OF_DAY}\\z", 0))


def _leading_clock(line: Column, separator: str) -> Column:
    return F.regexp_extract(line, f"^({TIME_OF_DAY})(?:\\Q{separator}\\E|\\z)", 1)


def leading_time(line: Column, separator: str = " ") -> Column:
    """Time of day before the first separator of a line; NULL when malformed."""
    return _normal_form(_leading_clock(line, separator))


def with_leading_time(
    lines: DataFrame, value: str = "value", separator: str = " ", name: str = "tod"
) -> DataFrame:
    """Add :func:`leading_time` as a column that filters may use freely.

    The search of the line sits in a one-row ``inline``, below which no filter is
    pushed, so it runs once per line; what is compared is the short text found.
    """
    once = F.inline(F.array(F.struct(_leading_clock(F.col(value), separator).alias("_clock"))))
    found = lines.select("*", once)
    return found.withColumn(name, _normal_form(F.col("_clock"))).drop("_clock")


def normal_time(text: str) -> str:
    """The same normal form for a configured bound; raises when malformed."""
    if not re.fullmatch(TIME_OF_DAY, text):
        raise ValueError(f"not a time of day: {text!r}")
    whole, _, fraction = (text + ":00" if len(text) == 5 else text).partition(".")
    return f"{whole}.{fraction[:3].ljust(3, '0')}{fraction[3:].rstrip('0')}"


def event_time(day: Column, clock: Column) -> Column:
    """Date plus time of day as a zone-free timestamp; NULL when either is bad."""
    whole = F.concat(day.cast("string"), F.lit(" "), F.when(clock != "", clock))
    return whole.try_cast("timestamp_ntz")


def floor_div(value: Column, size: int) -> Column:
    """Floor of an integer division, exact for any sign and size."""
    return F.call_function("div", value - F.pmod(value, F.lit(size)), F.lit(size))


def micros(df: DataFrame, column: str) -> Column:
    """Microseconds since 1970 of a timestamp column, whichever kind it is."""
    if isinstance(df.schema[column].dataType, T.TimestampNTZType):
        return F.expr(f"(`{column}` - {_EPOCH}) div {_MICRO}")
    return F.unix_micros(F.col(column).cast("timestamp"))


def from_micros(df: DataFrame, like: str, column: str) -> Column:
    """Inverse of :func:`micros`, giving the kind of column ``like``."""
    if isinstance(df.schema[like].dataType, T.TimestampNTZType):
        return F.expr(f"{_EPOCH} + {_MICRO} * `{column}`")
    return F.timestamp_micros(F.col(column))
