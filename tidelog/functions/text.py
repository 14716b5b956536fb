"""Fields of a raw log line ``HH:mm:ss.SSS [thread] LEVEL logger - message``."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidelog.schema import PRODUCER_LEVELS

# The form of a time of day, what parts a line's head from its message, and the
# number in a producer's file name.
TIME_PATTERN = r"[0-9]{2}:[0-9]{2}:[0-9]{2}\.[0-9]{3}"
MESSAGE_SEPARATOR = " - "
INSTANCE_PATTERN = r"([0-9]+)\.log$"

_LEVEL_TOKEN = f"(?:^| )({'|'.join(PRODUCER_LEVELS)})(?: |\\z)"
_BLANKS = "".join(map(chr, range(0x21)))


def strip_blanks(text: Column) -> Column:
    """Drop leading and trailing characters up to U+0020 (spaces, tabs, controls)."""
    return F.btrim(text, F.lit(_BLANKS))


def log_level(line: Column) -> Column:
    """First space-separated token that is a producer level, else ``''``.

    One anchored search that stops at the first hit, instead of splitting the
    whole line into an array.
    """
    return F.regexp_extract(line, _LEVEL_TOKEN, 1)


def log_message(line: Column, mode: str = "full") -> Column:
    """Message part of a line, without surrounding blanks.

    ``full`` keeps all text after the first separator. ``reference`` keeps only
    the last non-empty part, so a message that itself holds the separator loses
    its head; a line made of separators alone gives NULL. Without a separator
    both give the whole line.
    """
    if mode == "full":
        at = F.locate(MESSAGE_SEPARATOR, line)
        tail = F.substring(line, at + F.lit(len(MESSAGE_SEPARATOR)), F.length(line))
        return strip_blanks(F.when(at > 0, tail).otherwise(line))
    if mode == "reference":
        parts = F.filter(F.split(line, MESSAGE_SEPARATOR), lambda part: part != "")
        return strip_blanks(F.when(line == "", line).otherwise(F.try_element_at(parts, F.lit(-1))))
    raise ValueError(f"unknown message mode {mode!r}")


def log_timestamp(line: Column) -> Column:
    """First time of day with milliseconds anywhere in the line, else ``''``."""
    return F.regexp_extract(line, TIME_PATTERN, 0)


def file_instance(file_name: Column) -> Column:
    """Number of the producer in ``output<n>.log``; NULL for other names."""
    digits = F.regexp_extract(file_name, INSTANCE_PATTERN, 1)
    return F.when(digits != "", digits.try_cast("int"))
